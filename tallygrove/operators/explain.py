"""Feature importance and per-row contributions.

Contributions come in long form (key, feature, contribution), one row per source column, with the
one-hot slots of a category taken together. By the method ``"reference"`` they add up, for every row, to
the difference between the row's output and the output of the reference point. By the method ``"path"``
trees start from their mean output over the training rows, columns that are left out follow both
branches by the share of training rows that did, and a row ``BIAS`` holds the start: all rows of a key
add up to its output.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import factorial, inf

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
    NaiveBayesModel,
)
from pyspark.ml.feature import ImputerModel, OneHotEncoderModel, StringIndexerModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators.boosting import SecondOrderModel
from tallygrove.operators.calibrate import uncalibrated
from tallygrove.operators.features import (
    FEATURES,
    IMPUTED_SUFFIX,
    INDEX_SUFFIX,
    feature_slots,
    slot_sources,
)
from tallygrove.plans.spec import TableSpec
from tallygrove.sources.scratch import scratch_path

# The feature name of the row that holds where contributions start.
BIAS = "BiasTerm"
LINEAR_MODELS = (LogisticRegressionModel, LinearSVCModel, NaiveBayesModel)
# Rows that a task explains at a time.
CHUNK_ROWS = 4096
# Leaves with up to so many columns on their path have their shares worked out for every pattern.
TABLE_COLUMNS = 6


def _importances(model: PipelineModel, df: DataFrame) -> list[tuple[str, float]]:
    """(feature name, importance) per vector slot, highest first; reads the schema of ``df`` only.

    Second-order trees split source columns, so theirs are by column.
    """
    if isinstance(model.stages[-1], SecondOrderModel):
        gains = model.stages[-1].column_gains()
        return sorted(gains.items(), key=lambda pair: (-pair[1], pair[0]))
    scores = model.stages[-1].featureImportances
    slots = feature_slots(PipelineModel(stages=model.stages[:-1]).transform(df))
    named = [(name, float(scores[slot])) for slot, name in slots]
    return sorted(named, key=lambda pair: (-pair[1], pair[0]))


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Impurity importance by feature name, highest first; one row per vector slot."""
    return df.sparkSession.createDataFrame(_importances(model, df), "name STRING, score DOUBLE")


def variable_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importance as it is, relative to the highest, and as a share of the sum."""
    named = _importances(model, df)
    highest = max((score for _, score in named), default=0.0) or 1.0
    total = sum(score for _, score in named) or 1.0
    return df.sparkSession.createDataFrame(
        [(name, score, score / highest, score / total) for name, score in named],
        "variable STRING, relative_importance DOUBLE, scaled_importance DOUBLE, percentage DOUBLE",
    )


def _slot_terms(fitted) -> tuple[list[float], list[float]]:
    """Change of the margin per unit and per squared unit of each slot.

    The margin of Gaussian naive Bayes has a squared term for each slot; that of Bernoulli naive Bayes is
    linear, with weights from the chances that a slot is set and that it is not.
    """
    if not isinstance(fitted, NaiveBayesModel):
        linear = fitted.coefficients.toArray()
        return linear.tolist(), [0.0] * len(linear)
    kind, theta = fitted.getOrDefault("modelType"), fitted.theta.toArray()
    if kind == "gaussian":
        sigma = fitted.sigma.toArray()
        linear = theta[1] / sigma[1] - theta[0] / sigma[0]
        return linear.tolist(), (0.5 / sigma[0] - 0.5 / sigma[1]).tolist()
    if kind == "bernoulli":
        unset = np.log1p(-np.exp(theta))
        return (theta[1] - unset[1] - theta[0] + unset[0]).tolist(), [0.0] * theta.shape[1]
    # The weights of the complement form are log-odds against a class, as Spark scores with them.
    return (theta[1] - theta[0]).tolist(), [0.0] * theta.shape[1]


def linear_contributions(
    model: PipelineModel,
    df: DataFrame,
    spec: TableSpec,
    background: DataFrame | None = None,
    bias: bool = False,
) -> DataFrame:
    """Weight times the distance from the background's mean, for models with a linear margin.

    The margin is the log-odds, or the distance from the plane for the SVM. A category's part is
    looked up by its index, so no vector is unpacked. ``bias`` adds a row with the mean margin.
    """
    stages = PipelineModel(stages=model.stages[:-1])
    weights, squared = _slot_terms(model.stages[-1])
    features = stages.transform(df)
    reference = features if background is None else stages.transform(background)
    summary = Summarizer.metrics("mean", "normL2", "count").summary(F.col(FEATURES))
    margin = _margin(model.stages[-1])
    scored = model.stages[-1].transform(reference) if bias else reference
    seen = scored.agg(summary.alias("s"), (F.avg(margin) if bias else F.lit(0.0)).alias("start")).select(
        "s.*", "start"
    ).first()
    means, rows = seen["mean"], max(seen["count"], 1)
    mean_squares = [norm * norm / rows for norm in seen["normL2"]]
    slots: dict[str, list[int]] = {}
    for slot, source in slot_sources(features, spec):
        slots.setdefault(source, []).append(slot)

    def part(source: str) -> Column:
        own = slots[source]
        offset = sum(
            weights[i] * float(means[i]) + squared[i] * mean_squares[i] for i in own
        )
        if source in spec.numeric:
            x = F.col(source + IMPUTED_SUFFIX)
            value = x * F.lit(weights[own[0]])
            if squared[own[0]]:
                value = value + x * x * F.lit(squared[own[0]])
        else:
            index = F.col(source + INDEX_SUFFIX).cast("int")
            terms = [weights[i] + squared[i] for i in own]
            value = F.coalesce(F.get(F.lit(terms), index), F.lit(0.0))
        return value - F.lit(offset)

    cells = [
        F.struct(F.lit(source).alias("feature"), part(source).alias("contribution"))
        for source in slots
    ]
    if bias:
        start = F.lit(seen["start"]).cast("double")
        cells.append(F.struct(F.lit(BIAS).alias("feature"), start.alias("contribution")))
    return features.select(*spec.key, F.inline(F.array(*cells)))


def _margin(fitted) -> Column:
    """What linear contributions add up to."""
    positive = class_score("rawPrediction")
    if isinstance(fitted, NaiveBayesModel):
        return positive - class_score("rawPrediction", 0)
    return positive


def reference_row(model: PipelineModel, df: DataFrame) -> dict[str, object]:
    """The point that tree contributions start from: most frequent categories and mean numbers.

    Means take the types of their columns in ``df``, as the imputer does.
    """
    point: dict[str, object] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            point.update(
                (c, labels[0]) for c, labels in zip(stage.getInputCols(), stage.labelsArray)
            )
        elif isinstance(stage, ImputerModel):
            means = stage.surrogateDF
            typed = means.select(*(F.col(c).cast(df.schema[c].dataType) for c in means.columns))
            point.update(typed.first().asDict())
    return point


def model_output(model: PipelineModel) -> Column:
    """What contributions explain: log-odds for boosted trees, else the positive probability."""
    if isinstance(model.stages[-1], GBTClassificationModel):
        return 2 * class_score("rawPrediction")
    return class_score("probability")


@dataclass(frozen=True)
class Interval:
    """Numbers above the first and up to the second bound."""

    low: float
    high: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return (values > self.low) & (values <= self.high)


@dataclass(frozen=True)
class Places:
    """Indexes of a category: those listed, or all but those listed.

    The size depends on the splits of a path, not on how many values the column has.
    """

    listed: frozenset[int]
    inside: bool = False

    def holds(self, values: np.ndarray) -> np.ndarray:
        found = np.zeros(len(values), bool)
        for place in self.listed:
            found |= values == place
        return found if self.inside else ~found

    def only(self, place: int) -> Places:
        there = (place in self.listed) == self.inside
        return Places(frozenset([place]) if there else frozenset(), True)

    def without(self, place: int) -> Places:
        return Places(self.listed - {place} if self.inside else self.listed | {place}, self.inside)


@dataclass(frozen=True)
class Leaf:
    """A leaf's share of the output and, per source column on its path, what reaches it and which share
    of the training rows that came to the column's splits went this way."""

    value: float
    reached_by: dict[str, Interval | Places]
    shares: dict[str, float]


def slot_starts(model: PipelineModel, spec: TableSpec) -> tuple[list[int], list[str]]:
    """The first vector slot of each source column, and the columns in that order."""
    widths: dict[str, int] = {}
    for stage in model.stages:
        if isinstance(stage, OneHotEncoderModel):
            dropped = int(stage.getDropLast())
            widths.update(zip(spec.categorical, (size - dropped for size in stage.categorySizes)))
    columns = [*spec.categorical, *spec.numeric]
    ends = np.cumsum([widths.get(c, 1) for c in columns]).tolist()
    return [0, *ends[:-1]], columns


def tree_nodes(fitted, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted tree model, one row each: tree, id, children, split, statistics, prediction.

    They are read from the saved model, so the model's size costs one job and no calls per node.
    """
    path = scratch_path(spark, "tree-nodes")
    fitted.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "treeID" in nodes.columns:
        return nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    return nodes.select(F.lit(0).alias("tree"), "*")


def tree_leaves(model: PipelineModel, df: DataFrame, spec: TableSpec) -> list[Leaf]:
    """All leaves of a tree model, in terms of the source columns; as many as the model has."""
    fitted = model.stages[-1]
    boosted = isinstance(fitted, GBTClassificationModel)
    starts, columns = slot_starts(model, spec)
    n_trees = len(getattr(fitted, "trees", [fitted]))
    weights = list(fitted.treeWeights) if boosted else [1.0 / n_trees] * n_trees
    nodes = {(r["tree"], r["id"]): r for r in tree_nodes(fitted, df.sparkSession).collect()}

    def cover(node: Row) -> float:
        # Boosted trees are regressions: their statistics are the count, sum and sum of squares.
        return node["impurityStats"][0] if boosted else sum(node["impurityStats"])

    def leaf_value(node: Row, weight: float) -> float:
        if boosted:
            return 2 * weight * node["prediction"]
        total = sum(node["impurityStats"])
        return weight * node["impurityStats"][1] / total if total else 0.0

    def condition(before: Interval | Places | None, source: str, slot: int, split: Row, left: bool):
        cuts = split["leftCategoriesOrThreshold"]
        if source in spec.numeric:
            known = before or Interval(-inf, inf)
            if left:
                return Interval(known.low, min(known.high, cuts[0]))
            return Interval(max(known.low, cuts[0]), known.high)
        # Index i puts a one into slot i; the index after the last label leaves all slots at zero.
        if split["numCategories"] == -1:
            goes_left = [x <= cuts[0] for x in (0.0, 1.0)]
        else:
            goes_left = [x in cuts for x in (0.0, 1.0)]
        known = before or Places(frozenset())
        if goes_left[1] != left:
            known = known.without(slot)
        if goes_left[0] != left:
            known = known.only(slot)
        return known

    leaves = []
    for tree, weight in enumerate(weights):
        open_: list[tuple[Row, dict, dict]] = [(nodes[tree, 0], {}, {})]
        while open_:
            node, reached, shares = open_.pop()
            if node["leftChild"] < 0:
                leaves.append(Leaf(leaf_value(node, weight), reached, shares))
                continue
            split = node["split"]
            at = bisect_right(starts, split["featureIndex"]) - 1
            source, slot = columns[at], split["featureIndex"] - starts[at]
            for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
                there = nodes[tree, child]
                narrowed = condition(reached.get(source), source, slot, split, left)
                share = cover(there) / cover(node) if cover(node) else 0.0
                open_.append(
                    (
                        there,
                        {**reached, source: narrowed},
                        {**shares, source: shares.get(source, 1.0) * share},
                    )
                )
    return leaves


def _source_numbers(columns: Sequence[str], spec: TableSpec) -> list[Column]:
    """What conditions are about: a category's index, a number without nulls."""
    return [
        F.col(c + (INDEX_SUFFIX if c in spec.categorical else IMPUTED_SUFFIX)).cast("double")
        for c in columns
    ]


class _Seen:
    """Which rows of a chunk meet a condition, worked out once per condition."""

    def __init__(self, part: Sequence[np.ndarray]):
        self.part = part
        self.known: dict[tuple, np.ndarray] = {}

    def reaches(self, column: int, condition: Interval | Places) -> np.ndarray:
        if (column, condition) not in self.known:
            self.known[column, condition] = condition.holds(self.part[column])
        return self.known[column, condition]


def _per_row(
    features: DataFrame, spec: TableSpec, columns: Sequence[str], explain, more: Sequence[Column] = ()
) -> DataFrame:
    """``explain`` fills an array (rows, columns) from chunks of the source numbers; long form."""

    def worked_out(*values: pd.Series) -> pd.Series:
        rows = [v.to_numpy(np.float64) for v in values]
        out = np.zeros((len(rows[0]), len(columns)))
        for at in range(0, len(out), CHUNK_ROWS):
            explain([v[at : at + CHUNK_ROWS] for v in rows], out[at : at + CHUNK_ROWS])
        return pd.Series(list(out))

    # Marked so that the values are worked out once, not once per feature.
    values = F.pandas_udf(worked_out, "ARRAY<DOUBLE>").asNondeterministic()
    numbers = _source_numbers(columns, spec)
    explained = features.select(*spec.key, values(*numbers).alias("_values"))
    cells = F.arrays_zip(F.array(*(F.lit(c) for c in columns)).alias("feature"), F.col("_values"))
    named = F.transform(
        cells,
        lambda cell: F.struct(
            cell["feature"].alias("feature"), cell["_values"].alias("contribution")
        ),
    )
    return explained.select(*spec.key, F.inline(F.concat(named, F.array(*more)) if more else named))


def path_shares(patterns: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1 for each pattern of columns that the row passes.

    ``patterns`` has a row per pattern and a column per column of the path; ``shares`` are the parts of
    the training rows that passed. A coalition is worth the product over the columns: whether the row
    passes where the column is in it, the share where it is not. Extending the path by a column updates
    the sums of such products by coalition size; unwinding takes one column out again.
    """
    n_patterns, n = patterns.shape
    ones = patterns.astype(np.float64)
    sums = np.zeros((n_patterns, n + 1))
    sums[:, 0] = 1.0
    for d in range(n):
        taken = sums[:, : d + 1] * ones[:, [d]]
        sums[:, : d + 1] *= shares[d]
        sums[:, 1 : d + 2] += taken
    weights = np.array([factorial(k) * factorial(n - 1 - k) / factorial(n) for k in range(n)])
    out = np.zeros((n_patterns, n))
    for d in range(n):
        # Rows that pass: unwind from the largest coalitions; others: divide by the share.
        passes = patterns[:, d]
        rest = np.zeros((n_patterns, n))
        above = np.zeros(n_patterns)
        for k in range(n - 1, -1, -1):
            above = sums[:, k + 1] - above * shares[d]
            rest[:, k] = above
        if shares[d] > 0:
            rest[~passes] = sums[~passes, :n] / shares[d]
        else:
            # Nothing of the path is left without this column: build the sums anew.
            rest[~passes] = _sums_without(ones[~passes], shares, d)
        out[:, d] = (ones[:, d] - shares[d]) * (rest @ weights)
    return out


def _sums_without(ones: np.ndarray, shares: np.ndarray, without: int) -> np.ndarray:
    sums = np.zeros((len(ones), ones.shape[1]))
    sums[:, 0] = 1.0
    for d in range(ones.shape[1]):
        if d != without:
            taken = sums[:, :-1] * ones[:, [d]]
            sums *= shares[d]
            sums[:, 1:] += taken
    return sums


def path_contributions(model: PipelineModel, df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exact Shapley values of trees, where columns that are left out follow both branches by cover.

    The cover of a branch is the number of training rows that took it. All rows start from the mean
    output of the training rows, which is the row ``BIAS`` of every explained row. A leaf matters to the
    columns of its path only, so the work is leaves times path length, whatever the number of columns,
    and categories are sets of the few indexes that the path asks about. Rows are explained where they
    are, with neither a key nor a shuffle; the leaves, which the model's size bounds, go to the tasks.
    """
    columns = [*spec.categorical, *spec.numeric]
    start, prepared = 0.0, []
    for leaf in tree_leaves(model, df, spec):
        own = [(columns.index(c), condition) for c, condition in leaf.reached_by.items()]
        shares = np.array([leaf.shares[columns[c]] for c, _ in own])
        start += leaf.value * float(np.prod(shares))
        if own:
            prepared.append((leaf.value, own, np.array([c for c, _ in own]), shares))

    # A short path's values for every pattern; long paths look at the patterns that occur.
    tables: dict[int, np.ndarray] = {}

    def table(number: int) -> np.ndarray:
        if number not in tables:
            value, own, _, shares = prepared[number]
            codes = np.arange(1 << len(own))
            patterns = (codes[:, None] >> np.arange(len(own)) & 1).astype(bool)
            tables[number] = value * path_shares(patterns, shares)
        return tables[number]

    def explain(part: list[np.ndarray], out: np.ndarray) -> None:
        seen = _Seen(part)
        for number, (value, own, places, shares) in enumerate(prepared):
            passed = [seen.reaches(c, condition) for c, condition in own]
            if len(own) <= TABLE_COLUMNS:
                codes = np.zeros(len(out), np.int64)
                for d, p in enumerate(passed):
                    codes |= p.astype(np.int64) << d
                out[:, places] += table(number)[codes]
            else:
                found, same = np.unique(np.column_stack(passed), axis=0, return_inverse=True)
                out[:, places] += value * path_shares(found, shares)[same.ravel()]

    features = PipelineModel(stages=model.stages[:-1]).transform(df)
    bias = F.struct(F.lit(BIAS).alias("feature"), F.lit(float(start)).alias("contribution"))
    return _per_row(features, spec, columns, explain, [bias])


def tree_contributions(model: PipelineModel, df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exact Shapley values against ``reference_row``, for trees and their ensembles of any width.

    A coalition of columns takes their values from the row and the others from the reference point. A
    leaf counts for a coalition if every column on its path passes with the value it has. Let the row
    alone pass in a columns of the path and the reference alone in b; if any column fails in both, the
    leaf never counts. Then each of the a columns gets ``value * (a-1)! b! / (a+b)!`` and each of the b
    loses ``value * a! (b-1)! / (a+b)!``. Rows are explained where they are, with neither a key nor a
    shuffle; the leaves, which the model's size bounds, go to the tasks.
    """
    columns = [*spec.categorical, *spec.numeric]
    stages = PipelineModel(stages=model.stages[:-1])
    point = reference_row(model, df)
    types = {c: df.schema[c].dataType for c in columns}
    reference = df.sparkSession.range(1).select(
        *(F.lit(point[c]).cast(types[c]).alias(c) for c in columns)
    )
    at = list(stages.transform(reference).select(*_source_numbers(columns, spec)).first())
    start = {c: np.array([x]) for c, x in zip(columns, at)}
    prepared = []
    for leaf in tree_leaves(model, df, spec):
        held = {c: bool(cond.holds(start[c])[0]) for c, cond in leaf.reached_by.items()}
        prepared.append(
            (
                leaf.value,
                [(columns.index(c), leaf.reached_by[c]) for c, there in held.items() if not there],
                [(columns.index(c), leaf.reached_by[c]) for c, there in held.items() if there],
            )
        )
    n = len(columns)

    def explain(part: list[np.ndarray], out: np.ndarray) -> None:
        seen = _Seen(part)
        for value, row_only, shared in prepared:
            reached = np.ones(len(out), bool)
            for column, condition in row_only:
                reached &= seen.reaches(column, condition)
            chosen = np.flatnonzero(reached)
            if not len(chosen):
                continue
            missed = [(c, ~seen.reaches(c, condition)[chosen]) for c, condition in shared]
            b = sum((m for _, m in missed), np.zeros(len(chosen), np.int64))
            a = len(row_only)
            if a:
                gain = np.array([factorial(a - 1) * factorial(k) / factorial(a + k) for k in range(n + 1)])
                for column, _ in row_only:
                    out[chosen, column] += value * gain[b]
            loss = np.array(
                [0.0] + [factorial(a) * factorial(k - 1) / factorial(a + k) for k in range(1, n + 1)]
            )
            for column, m in missed:
                out[chosen[m], column] -= value * loss[b[m]]

    return _per_row(stages.transform(df), spec, columns, explain)


def contributions(
    model: PipelineModel,
    df: DataFrame,
    spec: TableSpec,
    background: DataFrame | None = None,
    method: str = "reference",
) -> DataFrame:
    """Per-row contributions, exact for the model.

    ``method="reference"``: against the reference row of trees or the background's means of linear
    models. ``method="path"``: trees by the cover of their branches; for every model with the row
    ``BIAS``, so that the rows of a key add up to its output.
    """
    if method not in ("reference", "path"):
        raise ValueError("method must be 'reference' or 'path'")
    model = uncalibrated(model)
    if isinstance(model.stages[-1], LINEAR_MODELS):
        return linear_contributions(model, df, spec, background, bias=method == "path")
    return path_contributions(model, df, spec) if method == "path" else tree_contributions(model, df, spec)


def explain_row(
    model: PipelineModel,
    df: DataFrame,
    spec: TableSpec,
    row: Sequence[object] | Mapping[str, object] | Column,
    background: DataFrame | None = None,
    method: str = "reference",
) -> DataFrame:
    """Contributions of the chosen rows, largest first; a start comes last. Only those are explained.

    ``row`` holds the values of the key, values by column (NULL matches NULL), or a condition; a table
    without a key needs one of the latter two.
    """
    if isinstance(row, Column):
        one = df.filter(row)
    else:
        if not isinstance(row, Mapping):
            if not spec.key:
                raise ValueError("the table has no key; give column values or a condition")
            row = dict(zip(spec.key, row, strict=True))
        one = df
        for column, value in row.items():
            one = one.filter(F.col(column).eqNullSafe(F.lit(value)))
    explained = contributions(model, one, spec, background if background is not None else df, method)
    if method == "path":
        return explained.orderBy(F.col("feature") == BIAS, F.desc(F.abs("contribution")), "feature")
    return explained.orderBy(F.desc(F.abs("contribution")), "feature")


def contribution_summary(contrib: DataFrame) -> DataFrame:
    """Mean absolute contribution of each feature; where rows start from is none."""
    return contrib.filter(F.col("feature") != BIAS).groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution")
    )
