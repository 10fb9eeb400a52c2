"""Second-order boosted trees on histograms, as DataFrame aggregates.

Every level of a tree is one aggregation: gradients and hessians of the logistic loss are summed per
(node, column, bin), and the best split of each node is found from those sums in the same job. Only one row
per node reaches the driver. A split's gain is

    (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2

and a leaf is worth ``-G / (H + l2)`` times the step. Numbers are cut into at most ``maxBins`` bins at
quantiles; rows without a number go to the side that gains more (to the right where both gain the same). A
category is split one value against all others, and null is a value of its own. Both sides of a split need
a hessian of ``minChildWeight``, and the gain must exceed ``minGain``. Of equal gains the first column in
order wins, then the smallest cut or value.

Rows hold the margin so far; a new margin is one expression over the bins. It is cached round by round and
written to the shared scratch folder every ``WRITE_ROUNDS`` rounds, so that a lost executor costs a few
rounds. With a validation column, marked rows train nothing; the loss on them ends the fit after
``patience`` rounds without a better one, and the rounds after the best are cut off.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from math import inf

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasStepSize,
    HasValidationIndicatorCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallygrove.sources.scratch import saved_table

WRITE_ROUNDS = 10
# Gains that differ by less are equal: sums of doubles depend on the order of the rows.
GAIN_PLACES = 9
ROOT = 1


class _BoostingParams(
    HasLabelCol,
    HasMaxIter,
    HasStepSize,
    HasValidationIndicatorCol,
    HasRawPredictionCol,
    HasProbabilityCol,
    HasPredictionCol,
):
    """Settings that the estimator and its model share."""

    categoricalCols = Param(Params._dummy(), "categoricalCols", "category columns", TypeConverters.toListString)
    numericCols = Param(Params._dummy(), "numericCols", "number columns", TypeConverters.toListString)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a number column", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "added to every sum of hessians", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian of a side", TypeConverters.toFloat)
    minGain = Param(Params._dummy(), "minGain", "gain that a split must exceed", TypeConverters.toFloat)
    patience = Param(
        Params._dummy(), "patience", "rounds without a better validation loss before the fit ends", TypeConverters.toInt
    )

    def __init__(self, *args):
        super().__init__(*args)
        # The defaults that this kind of trees is usually given.
        self._setDefault(
            categoricalCols=[],
            numericCols=[],
            maxIter=20,
            stepSize=0.3,
            maxDepth=5,
            maxBins=256,
            l2=1.0,
            minChildWeight=1.0,
            minGain=0.0,
            patience=3,
        )

    def columns(self) -> list[str]:
        return [*self.getOrDefault("categoricalCols"), *self.getOrDefault("numericCols")]


def _number(column: str) -> str:
    """A column as a double without NaN, in SQL."""
    name = "`" + column.replace("`", "``") + "`"
    return f"nullif(cast({name} AS DOUBLE), double('NaN'))"


def _text(value: str | None) -> str:
    """A literal in SQL."""
    if value is None:
        return "cast(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _goes_left(split: Mapping, binned: bool) -> str:
    """Whether a row takes the left branch, by the bins of a training row or by raw values."""
    if "value" in split:
        name = f"c{split['at']}" if binned else "`" + split["column"].replace("`", "``") + "`"
        return f"cast({name} AS STRING) <=> {_text(split['value'])}"
    left = str(bool(split["missing_left"])).lower()
    if binned:
        return f"coalesce(b{split['at']} <= {split['bin']}, {left})"
    return f"coalesce({_number(split['column'])} < double('{split['cut']!r}'), {left})"


def tree_sql(tree: Mapping[int, Mapping], binned: bool, node: int = ROOT, numbers: bool = False) -> str:
    """The tree as nested conditions in SQL, whose text is parsed at once; it gives the leaf's value or,
    with ``numbers``, its number."""
    here = tree[node]
    if "split" not in here:
        return str(node) if numbers else f"double('{here['value']!r}')"
    left, right = (tree_sql(tree, binned, 2 * node + side, numbers) for side in (0, 1))
    return f"if({_goes_left(here['split'], binned)}, {left}, {right})"


def logistic_loss(margin: Column, label: Column) -> Column:
    """Logistic loss of a row, without overflow."""
    signed = F.when(label == 1, margin).otherwise(-margin)
    return F.log1p(F.exp(-F.abs(signed))) + F.greatest(-signed, F.lit(0.0))


class SecondOrderBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Trains on the source columns themselves; the label is 0 or 1."""

    @keyword_only
    def __init__(self, *, labelCol="label", categoricalCols=None, numericCols=None):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _cuts(self, df: DataFrame) -> list[list[float]]:
        """Quantiles of every number column, in one pass."""
        numeric, bins = self.getOrDefault("numericCols"), self.getOrDefault("maxBins")
        if not numeric:
            return []
        probes = [i / bins for i in range(1, bins)] or [0.5]
        found = df.agg(
            *(F.percentile_approx(F.expr(_number(c)), probes, 40 * bins).alias(f"q{i}") for i, c in enumerate(numeric))
        ).first()
        return [sorted(set(found[f"q{i}"] or [0.0])) for i in range(len(numeric))]

    def _binned(self, df: DataFrame, cuts: Sequence[Sequence[float]]) -> DataFrame:
        """Label, validation mark, margin, categories and bins; the bin counts the cuts up to the number."""
        numeric, categorical = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        held_out = (
            F.col(self.getOrDefault("validationIndicatorCol")) if self.isSet("validationIndicatorCol") else F.lit(False)
        )
        raw = df.select(
            F.col(self.getOrDefault("labelCol")).cast("int").alias("label"),
            F.coalesce(held_out, F.lit(False)).alias("held_out"),
            F.lit(0.0).alias("margin"),
            *(F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(categorical)),
            *(F.expr(_number(c)).alias(f"x{i}") for i, c in enumerate(numeric)),
        )
        if not numeric:
            return raw
        buckets = Bucketizer(
            splitsArray=[[-inf, *own, inf] for own in cuts],
            inputCols=[f"x{i}" for i in range(len(numeric))],
            outputCols=[f"k{i}" for i in range(len(numeric))],
            handleInvalid="keep",
        )
        # A missing number has no bin.
        bins = [
            F.when(F.col(f"x{i}").isNotNull(), F.col(f"k{i}")).cast("int").alias(f"b{i}") for i in range(len(numeric))
        ]
        return buckets.transform(raw).select(*(c for c in raw.columns if c[0] != "x"), *bins)

    def _best_splits(self, state: DataFrame, tree: Mapping[int, Mapping], open_: Sequence[int]) -> list[Row]:
        """The best split of every open node, if any fits; one aggregation over the training rows."""
        n_categorical = len(self.getOrDefault("categoricalCols"))
        n_numeric = len(self.getOrDefault("numericCols"))
        cells = [f"struct({i} AS column, cast(NULL AS INT) AS bin, c{i} AS value)" for i in range(n_categorical)]
        cells += [
            f"struct({n_categorical + i} AS column, b{i} AS bin, cast(NULL AS STRING) AS value)"
            for i in range(n_numeric)
        ]
        rows = (
            state.filter("NOT held_out")
            .selectExpr(f"{tree_sql(tree, True, numbers=True)} AS node", "1 / (1 + exp(-margin)) AS p", "*")
            .filter(f"node IN ({', '.join(map(str, open_))})")
            .selectExpr("node", "p - label AS g", "p * (1 - p) AS h", f"inline(array({', '.join(cells)}))")
        )
        sums = rows.groupBy("node", "column", "bin", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        # Running sums over the bins of a number, whose count is bounded; a value of a category is alone.
        # Rows without a number come first in the order, and both sides are tried for them.
        alone = f"column < {n_categorical}"
        bins = f"(PARTITION BY node, column, if({alone}, xxhash64(value), 0) ORDER BY bin NULLS FIRST)"
        every = f"(PARTITION BY node, column, if({alone}, xxhash64(value), 0))"
        running = sums.selectExpr(
            "*",
            f"sum(g) OVER {bins} AS gb",
            f"sum(h) OVER {bins} AS hb",
            f"coalesce(sum(if(bin IS NULL, g, NULL)) OVER {every}, 0) AS g0",
            f"coalesce(sum(if(bin IS NULL, h, NULL)) OVER {every}, 0) AS h0",
            f"max(bin) OVER {every} AS last",
        ).filter(f"{alone} OR bin < last")
        # A node's totals are known from its parent's split.
        totals = ", ".join(f"{n}, struct(double('{tree[n]['g']!r}') AS g, double('{tree[n]['h']!r}') AS h)" for n in open_)
        one_side = "struct(false AS missing_left, g AS gl, h AS hl)"
        two_sides = (
            "struct(false AS missing_left, gb - g0 AS gl, hb - h0 AS hl), "
            "struct(true AS missing_left, gb AS gl, hb AS hl)"
        )
        tried = running.selectExpr(
            "node", "column", "bin", "value", f"map({totals})[node] AS whole",
            f"inline(if({alone}, array({one_side}), array({two_sides})))",
        ).selectExpr("*", "whole.g - gl AS gr", "whole.h - hl AS hr")
        l2, least = self.getOrDefault("l2"), self.getOrDefault("minChildWeight")

        def score(side: str) -> str:
            return f"g{side} * g{side} / (h{side} + {l2!r}D)"

        before = f"whole.g * whole.g / (whole.h + {l2!r}D)"
        gain = f"round(({score('l')} + {score('r')} - {before}) / 2, {GAIN_PLACES})"
        best = f"min(struct(-{gain} AS loss, column, missing_left, bin, value, gl, hl))"
        found = tried.filter(f"hl >= {least!r}D AND hr >= {least!r}D").groupBy("node").agg(F.expr(best).alias("best"))
        return found.select("node", "best.*").filter(f"-loss > {self.getOrDefault('minGain')!r}D").collect()

    def _grown(self, state: DataFrame, cuts: Sequence[Sequence[float]], g: float, h: float) -> dict[int, dict]:
        """One tree, level by level: nodes by number, the children of n being 2n and 2n + 1."""
        names, n_categorical = self.columns(), len(self.getOrDefault("categoricalCols"))
        step, l2 = self.getOrDefault("stepSize"), self.getOrDefault("l2")

        def node(g: float, h: float) -> dict:
            return {"g": g, "h": h, "value": -g / (h + l2) * step if h + l2 else 0.0}

        tree, open_ = {ROOT: node(g, h)}, [ROOT]
        for _ in range(self.getOrDefault("maxDepth")):
            if not open_:
                break
            splits = self._best_splits(state, tree, open_)
            open_ = []
            for row in sorted(splits, key=lambda r: r["node"]):
                at, here = row["column"], tree[row["node"]]
                split = {"column": names[at], "at": at}
                if at < n_categorical:
                    split["value"] = row["value"]
                else:
                    split["at"] = at - n_categorical
                    own = cuts[split["at"]]
                    split |= {"bin": row["bin"], "cut": own[row["bin"]], "missing_left": row["missing_left"]}
                here |= {"split": split, "gain": -row["loss"]}
                tree[2 * row["node"]] = node(row["gl"], row["hl"])
                tree[2 * row["node"] + 1] = node(here["g"] - row["gl"], here["h"] - row["hl"])
                open_ += [2 * row["node"], 2 * row["node"] + 1]
        return tree

    def _fit(self, dataset: DataFrame) -> SecondOrderModel:
        cuts = self._cuts(dataset)
        state = self._binned(dataset, cuts).persist(StorageLevel.MEMORY_AND_DISK)
        p = 1 / (1 + F.exp(-F.col("margin")))
        inside = ~F.col("held_out")
        loss = logistic_loss(F.col("margin"), F.col("label"))
        seen = [
            F.sum(F.when(inside, p - F.col("label"))).alias("g"),
            F.sum(F.when(inside, p * (1 - p))).alias("h"),
            F.avg(F.when(inside, loss)).alias("loss"),
            F.avg(F.when(~inside, loss)).alias("validation_loss"),
        ]
        trees: list[dict[int, dict]] = []
        history: list[tuple[float, float | None]] = []
        best, rounds = 0, self.getOrDefault("maxIter")
        try:
            sums = state.agg(*seen).first()
            start = (sums["loss"], sums["validation_loss"])
            while sums["h"] and len(trees) < rounds:
                tree = self._grown(state, cuts, sums["g"], sums["h"])
                trees.append(tree)
                moved = state.withColumn("margin", F.expr(f"margin + {tree_sql(tree, True)}"))
                if len(trees) % WRITE_ROUNDS == 0:
                    moved = saved_table(moved, "boosting-rounds")
                before, state = state, moved.persist(StorageLevel.MEMORY_AND_DISK)
                sums = state.agg(*seen).first()
                before.unpersist()
                history.append((sums["loss"], sums["validation_loss"]))
                if sums["validation_loss"] is None:
                    best = len(trees)
                    continue
                lowest = history[best - 1][1] if best else start[1]
                if sums["validation_loss"] < lowest:
                    best = len(trees)
                elif len(trees) - best >= self.getOrDefault("patience"):
                    break
        finally:
            state.unpersist()
        model = SecondOrderModel()
        self._copyValues(model)
        model._set(
            trees=json.dumps([{str(n): v for n, v in tree.items()} for tree in trees[:best]]),
            history=json.dumps([start, *history]),
        )
        return model


class SecondOrderModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Trees of a fit, kept as text so that the model saves and loads like any other stage."""

    trees = Param(Params._dummy(), "trees", "nodes of each tree", TypeConverters.toString)
    history = Param(Params._dummy(), "history", "losses before the first and after each round", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(trees="[]", history="[]")

    def nodes(self) -> list[dict[int, dict]]:
        return [{int(n): v for n, v in tree.items()} for tree in json.loads(self.getOrDefault("trees"))]

    def round_losses(self) -> list[tuple[int, float, float | None]]:
        """(round, loss on training rows, loss on validation rows), from before the first round on."""
        return [(i, *pair) for i, pair in enumerate(json.loads(self.getOrDefault("history")))]

    def getNumTrees(self) -> int:
        return len(self.nodes())

    def column_gains(self) -> dict[str, float]:
        """Total gain of the splits on each column, as a share of all gain."""
        gains = dict.fromkeys(self.columns(), 0.0)
        for tree in self.nodes():
            for node in tree.values():
                if "split" in node:
                    gains[node["split"]["column"]] += node["gain"]
        total = sum(gains.values()) or 1.0
        return {column: gain / total for column, gain in gains.items()}

    def margin(self) -> Column:
        """Log-odds of a row, as one expression over the source columns."""
        return F.expr(" + ".join(["double(0)", *(tree_sql(t, False) for t in self.nodes())]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = dataset.withColumn("_margin", self.margin())
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return scored.withColumns(
            {
                self.getOrDefault("rawPredictionCol"): array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
                self.getOrDefault("probabilityCol"): array_to_vector(F.array(1 - p, p)),
                self.getOrDefault("predictionCol"): (F.col("_margin") > 0).cast("double"),
            }
        ).drop("_margin")
