"""Forests grown from counts of equal rows.

A forest draws every row a Poisson number of times for each tree. The sum of n such draws is one Poisson draw of
n times the mean, so equal rows are drawn together, by their number: the bags have the law of single rows. (A
weight n would draw all n rows or none, and give other forests.) A tree sees a number by its bin alone, so
the combinations of bins and categories that occur are all it needs, and their number does not grow with the rows
once they have all been met. The trees are grown in tasks, several per task, with the rules of Spark's: best gain
over a random subset of the vector's slots at every node, children of equal prediction merged.

Where Spark draws a sample of rows for the bins of a number, all rows are taken. The trees depend on the seed and
the rows, not on partitions. Tables with too many combinations or with labels other than 0 and 1 are left to
Spark, row by row, and so are those with infinite numbers, which it refuses.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from math import ceil, inf, isfinite, log2, nextafter, prod, sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.operators.classifiers import LEVELS, ROWS
from tallygrove.operators.features import IMPUTED_SUFFIX, INDEX_SUFFIX
from tallygrove.plans.spec import TableSpec
from tallygrove.sources.scratch import scratch_path

# Combinations times columns that the driver and every task hold at most: 40 MB of places. Beyond, rows are left to Spark.
MOST_CELLS = 10_000_000
# How many of n slots a node looks at.
SUBSETS = {
    "all": lambda n: n,
    "sqrt": lambda n: ceil(sqrt(n)),
    "log2": lambda n: max(1, ceil(log2(n))),
    "onethird": lambda n: ceil(n / 3),
}
# The nodes of a forest as Spark stores them, in SQL and in Arrow.
NODES = (
    "treeID INT, nodeData STRUCT<id: INT, prediction: DOUBLE, impurity: DOUBLE, impurityStats: ARRAY<DOUBLE>, "
    "rawCount: BIGINT, gain: DOUBLE, leftChild: INT, rightChild: INT, "
    "split: STRUCT<featureIndex: INT, leftCategoriesOrThreshold: ARRAY<DOUBLE>, numCategories: INT>>"
)
SPLIT = pa.struct(
    [
        ("featureIndex", pa.int32()),
        ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
        ("numCategories", pa.int32()),
    ]
)
NODE = pa.struct(
    [
        ("id", pa.int32()),
        ("prediction", pa.float64()),
        ("impurity", pa.float64()),
        ("impurityStats", pa.list_(pa.float64())),
        ("rawCount", pa.int64()),
        ("gain", pa.float64()),
        ("leftChild", pa.int32()),
        ("rightChild", pa.int32()),
        ("split", SPLIT),
    ]
)
# A child that is purer than this is not split further.
PURE = np.finfo(float).eps


def can_bag(estimator) -> bool:
    """Whether a forest with these settings can be grown from counts."""
    return (
        isinstance(estimator, RandomForestClassifier)
        and estimator.getImpurity() in ("gini", "entropy")
        and estimator.getFeatureSubsetStrategy() in ("auto", *SUBSETS)
        and estimator.getMaxBins() <= LEVELS
        and not (estimator.hasParam("weightCol") and estimator.isDefined("weightCol"))
    )


def _widths(features: PipelineModel) -> list[int]:
    """Slots of every category in the vector; an index after the last of them leaves all of them at zero."""
    return [
        len(labels) for s in features.stages if isinstance(s, StringIndexerModel) for labels in s.labelsArray
    ]


def fits_in_tasks(estimator, features: PipelineModel, spec: TableSpec, counted: int) -> bool:
    """Whether the combinations of bins and categories are few enough to be held, given so many counted rows."""
    possible = prod(n + 1 for n in _widths(features)) * prod(estimator.getMaxBins() for _ in spec.numeric)
    columns = len(spec.categorical) + len(spec.numeric)
    return min(possible, counted) * columns <= MOST_CELLS


@dataclass(frozen=True)
class Slots:
    """What a column is in the vector: a number with the cuts between its bins, or a slot per category."""

    first: int
    width: int
    cuts: tuple[float, ...] | None = None

    @property
    def size(self) -> int:
        """Places that a row can have: bins, or the categories and none of them."""
        return (self.width if self.cuts is None else len(self.cuts)) + 1


@dataclass(frozen=True)
class Combinations:
    """Combinations that occur: the place in every column, and the rows of label 0 and of label 1."""

    columns: list[Slots]
    places: np.ndarray
    rows: np.ndarray

    @property
    def slots(self) -> int:
        return sum(column.width for column in self.columns)


def find_cuts(values: Sequence[float], rows: Sequence[int], most: int) -> tuple[float, ...]:
    """At most about ``most`` cuts between sorted values so that the bins have about equal numbers of rows, as Spark's."""
    middles = [(low + high) / 2 for low, high in zip(values, values[1:])]
    if len(middles) <= most:
        return tuple(middles)
    stride = sum(rows) / (most + 1)
    cuts, seen, target = [], rows[0], stride
    for middle, more in zip(middles, rows[1:]):
        before, seen = seen, seen + more
        if abs(before - target) < abs(seen - target):
            cuts.append(middle)
            target += stride
    return tuple(cuts)


def _cuts(ready: DataFrame, numbers: Sequence[str], max_bins: int) -> list[tuple[float, ...]] | None:
    """The cuts of every number over counted rows; None if some number is infinite."""
    if not numbers:
        return []
    each = F.array(
        *(F.struct(F.lit(i).alias("place"), F.col(c).cast("double").alias("value")) for i, c in enumerate(numbers))
    )
    listed = ready.select(ROWS, F.explode(each).alias("v")).groupBy("v.place", "v.value")
    found: list[list[tuple[float, int]]] = [[] for _ in numbers]
    for place, value, n in listed.agg(F.sum(ROWS)).collect():
        if value is None or not isfinite(value):
            return None
        found[place].append((value, n))
    cuts = []
    for column in found:
        values, rows = zip(*sorted(column)) if column else ((), ())
        cuts.append(find_cuts(values, rows, min(max_bins, sum(rows)) - 1))
    return cuts


def combinations(
    counted: DataFrame, features: PipelineModel, spec: TableSpec, max_bins: int
) -> Combinations | None:
    """The combinations of bins and categories among counted rows; None if they are for Spark."""
    ready = features.transform(counted)
    numbers = [c + IMPUTED_SUFFIX for c in spec.numeric]
    cuts = _cuts(ready, numbers, max_bins)
    if cuts is None:
        return None
    cut = {c: of for c, of in zip(numbers, cuts) if of}
    names = [f"_place {i}" for i in range(len(spec.categorical) + len(numbers))]
    bins = dict(zip(numbers, names[len(spec.categorical):]))
    if cut:
        # A bucket ends before its upper bound, a bin with it.
        ready = Bucketizer(
            inputCols=list(cut), outputCols=[bins[c] for c in cut],
            splitsArray=[[-inf, *(nextafter(x, inf) for x in of), inf] for of in cut.values()],
        ).transform(ready)
    places = [F.col(c + INDEX_SUFFIX) for c in spec.categorical]
    places += [F.col(bins[c]) if c in cut else F.lit(0) for c in numbers]
    label = F.col(spec.label)
    found = (
        ready.select(*(p.cast("int").alias(n) for p, n in zip(places, names)), label, ROWS)
        .groupBy(*names)
        .agg(*(F.coalesce(F.sum(F.when(label == k, F.col(ROWS))), F.lit(0)) for k in (0, 1)), F.sum(ROWS))
        .toArrow()
    )
    *at, none, some, all_ = (column.to_numpy() for column in found.columns)
    if not none.sum() or not some.sum() or none.sum() + some.sum() != all_.sum():
        return None
    # The draws go by the order of the combinations, so it must not hang on partitions.
    order = np.lexsort(at[::-1]) if at else np.arange(len(all_))
    columns, first = [], 0
    for width in _widths(features):
        columns.append(Slots(first, width))
        first += width
    for i, of in enumerate(cuts):
        columns.append(Slots(first + i, 1, of))
    held = np.array([column[order] for column in at], dtype=np.int32).reshape(len(at), len(order))
    return Combinations(columns, held, np.array([none[order], some[order]], dtype=np.int64))


class Bags:
    """The combinations of a table of counted rows, worked out once for all forests that learn from it."""

    def __init__(self, counted: DataFrame, features: PipelineModel, spec: TableSpec):
        self.counted, self.features, self.spec = counted, features, spec
        self.lock, self.made = threading.Lock(), {}

    def of(self, max_bins: int) -> Broadcast | None:
        with self.lock:
            if max_bins not in self.made:
                found = combinations(self.counted, self.features, self.spec, max_bins)
                context = self.counted.sparkSession.sparkContext
                self.made[max_bins] = None if found is None else context.broadcast(found)
            return self.made[max_bins]

    def release(self) -> None:
        with self.lock:
            for held in self.made.values():
                if held is not None:
                    held.unpersist()
            self.made.clear()


@dataclass(frozen=True)
class Rules:
    """How the trees of a forest are grown."""

    depth: int
    entropy: bool
    per_node: int
    bootstrap: bool
    rate: float
    least_rows: float
    least_gain: float
    seed: int

    def impurity(self, none: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Of nodes with so many rows of either label; zero without rows."""
        total = none + some
        shares = [np.divide(n, total, out=np.zeros_like(total), where=total > 0) for n in (none, some)]
        if self.entropy:
            return 0.0 - sum(s * np.log2(s, out=np.zeros_like(s), where=s > 0) for s in shares)
        return np.where(total > 0, 1 - shares[0] ** 2 - shares[1] ** 2, 0.0)

    def draw(self, rows: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """How often rows that are equal are in the bag of a tree, all together."""
        if self.bootstrap:
            return random.poisson(self.rate * rows)
        return random.binomial(rows, self.rate) if self.rate < 1 else rows

    def gains(self, left: np.ndarray, whole: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Of splits (node, split) that send rows ``left`` of either label to the left; minus infinity if not allowed."""
        right = whole[:, :, None] - left
        n_left, n_right = left.sum(0), right.sum(0)
        total = np.maximum(n_left + n_right, 1)
        gains = (
            before[:, None] - n_left / total * self.impurity(*left) - n_right / total * self.impurity(*right)
        )
        refused = (np.minimum(n_left, n_right) < self.least_rows) | (gains < self.least_gain)
        gains[refused] = -inf
        return gains


def rules(forest: RandomForestClassifier, found: Combinations) -> Rules:
    strategy = forest.getFeatureSubsetStrategy()
    if strategy == "auto":
        strategy = "all" if forest.getNumTrees() == 1 else "sqrt"
    share = forest.getMinWeightFractionPerNode() * float(found.rows.sum())
    return Rules(
        forest.getMaxDepth(), forest.getImpurity() == "entropy", SUBSETS[strategy](found.slots),
        forest.getBootstrap(), forest.getSubsamplingRate(), max(forest.getMinInstancesPerNode(), share),
        forest.getMinInfoGain(), forest.getSeed(),
    )


@dataclass
class Level:
    """The nodes of one depth: rows of either label, and the split of those that have one."""

    rows: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray
    slot: np.ndarray
    column: np.ndarray
    place: np.ndarray
    one_left: np.ndarray
    left: np.ndarray


def _splits(
    columns: Sequence[Slots], places: np.ndarray, drawn: np.ndarray, at: np.ndarray, whole: np.ndarray,
    by: Rules, random: np.random.Generator,
) -> Level:
    """The best split of every node (``at`` holds each combination's) over the slots it looks at."""
    nodes = whole.shape[1]
    slots = sum(column.width for column in columns)
    before = by.impurity(*whole)
    gains, cut_of = np.full((nodes, slots), -inf), np.zeros((nodes, slots), dtype=np.int64)
    column_of = np.repeat(np.arange(len(columns)), [column.width for column in columns])
    tables = []
    for column, place in zip(columns, places):
        key, size = at * column.size + place, nodes * column.size
        table = np.array([np.bincount(key, n, size) for n in drawn]).reshape(2, nodes, column.size)
        if column.cuts is None:
            table = table[:, :, : column.width]
            gains[:, column.first : column.first + column.width] = by.gains(table, whole, before)
        else:
            table = table.cumsum(2)[:, :, :-1]
            if column.cuts:
                each = by.gains(table, whole, before)
                best = each.argmax(1)
                cut_of[:, column.first] = best
                gains[:, column.first] = each[np.arange(nodes), best]
        tables.append(table)
    if by.per_node < slots:
        others = random.random((nodes, slots)).argpartition(by.per_node, axis=1)[:, by.per_node :]
        np.put_along_axis(gains, others, -inf, axis=1)
    each = np.arange(nodes)
    slot = gains.argmax(1) if slots else np.zeros(nodes, dtype=np.int64)
    gain = gains[each, slot] if slots else np.full(nodes, -inf)
    of = column_of[slot] if slots else slot
    place, left, one_left = np.zeros(nodes, dtype=np.int64), np.zeros((2, nodes)), np.zeros(nodes, dtype=bool)
    for i, (column, table) in enumerate(zip(columns, tables)):
        here = np.flatnonzero((of == i) & (gain > 0))
        place[here] = slot[here] - column.first if column.cuts is None else cut_of[here, slot[here]]
        left[:, here] = table[:, here, place[here]]
        if column.cuts is None:
            # The side with fewer rows of label 1 goes left.
            one_left[here] = 2 * left[1, here] < whole[1, here]
            left[:, here] = np.where(one_left[here], left[:, here], whole[:, here] - left[:, here])
    # Spark marks a node for which it found no split that is allowed.
    return Level(whole, np.where(gain > -inf, before, -1.0), gain, slot, of, place, one_left, left)


def grow(found: Combinations, by: Rules, tree: int) -> list[tuple]:
    """The nodes of a tree as Spark stores them, each before its children."""
    random = np.random.default_rng([by.seed & (2**64 - 1), tree])
    drawn = by.draw(found.rows, random).astype(float)
    in_bag = drawn.any(axis=0)
    drawn, places = drawn[:, in_bag], found.places[:, in_bag]
    is_number = np.array([column.cuts is not None for column in found.columns], dtype=bool)
    at = np.zeros(drawn.shape[1], dtype=np.int64)
    # Nodes by number; a child is its parent's pair plus 0 or 1, a node without children has -1.
    rows: list[np.ndarray] = [drawn.sum(1)]
    impurity, gain = [float(by.impurity(*rows[0][:, None])[0])], [-1.0]
    children: list[int] = [-1]
    split: list[tuple[int, int, int, bool] | None] = [None]
    open_ = [0]
    for depth in range(by.depth):
        if not open_:
            break
        level = _splits(found.columns, places, drawn, at, np.array([rows[n] for n in open_]).T, by, random)
        right = level.rows - level.left
        impurities = by.impurity(*level.left), by.impurity(*right)
        following, goes = [], np.full((2, len(open_)), -1, dtype=np.int64)
        for i, node in enumerate(open_):
            impurity[node] = float(level.impurity[i])
            if not level.gain[i] > 0:
                continue
            gain[node] = float(level.gain[i])
            split[node] = int(level.column[i]), int(level.slot[i]), int(level.place[i]), bool(level.one_left[i])
            children[node] = len(rows)
            for side, counts in enumerate((level.left, right)):
                if depth + 1 < by.depth and impurities[side][i] >= PURE:
                    goes[side, i] = len(following)
                    following.append(len(rows))
                rows.append(counts[:, i])
                impurity.append(float(impurities[side][i]))
                gain.append(-1.0)
                children.append(-1)
                split.append(None)
        open_ = following
        if not open_:
            break
        of = level.column[at]
        place, where = places[of, np.arange(len(at))], level.place[at]
        left = np.where(is_number[of], place <= where, (place == where) == level.one_left[at])
        at = np.where(left, goes[0, at], goes[1, at])
        kept = at >= 0
        at, drawn, places = at[kept], drawn[:, kept], places[:, kept]
    prediction = [float(n[1] > n[0]) for n in rows]
    for node in reversed(range(len(rows))):
        pair = children[node]
        if pair >= 0 and children[pair] < 0 and children[pair + 1] < 0 and prediction[pair] == prediction[pair + 1]:
            prediction[node], children[node], gain[node] = prediction[pair], -1, -1.0
    numbers, waiting, order = {}, [0], []
    while waiting:
        node = waiting.pop()
        numbers[node] = len(order)
        order.append(node)
        if children[node] >= 0:
            waiting += [children[node] + 1, children[node]]
    stored = []
    for node in order:
        pair = children[node]
        told = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        if pair >= 0:
            column, slot, place, one_left = split[node]
            cuts = found.columns[column].cuts
            sides = [float(one_left)] if cuts is None else [cuts[place]]
            told = {
                "featureIndex": slot, "leftCategoriesOrThreshold": sides,
                "numCategories": 2 if cuts is None else -1,
            }
        stored.append(
            (
                numbers[node], prediction[node], impurity[node], rows[node].tolist(), int(rows[node].sum()), gain[node],
                numbers[pair] if pair >= 0 else -1, numbers[pair + 1] if pair >= 0 else -1, told,
            )
        )
    return stored


def _grown(batches: Iterable[pa.RecordBatch], found: Broadcast, by: Rules) -> Iterator[pa.RecordBatch]:
    """The nodes of the trees whose numbers come in."""
    names = [NODE.field(i).name for i in range(NODE.num_fields)]
    for batch in batches:
        for tree in batch.column(0).to_pylist():
            nodes = [dict(zip(names, node)) for node in grow(found.value, by, tree)]
            numbers = pa.array([tree] * len(nodes), pa.int32())
            yield pa.RecordBatch.from_arrays([numbers, pa.array(nodes, NODE)], ["treeID", "nodeData"])


def _settings(forest: RandomForestClassifier, only: Sequence[str] | None = None) -> dict[str, dict[str, object]]:
    chosen = {"paramMap": forest._paramMap, "defaultParamMap": forest._defaultParamMap}
    return {
        kind: {p.name: value for p, value in of.items() if only is None or p.name in only}
        for kind, of in chosen.items()
    }


# The settings of a forest that each of its trees has as well.
OF_TREES = (
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth",
    "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol",
    "probabilityCol", "rawPredictionCol", "seed",
)


def _as_java_model(spark: SparkSession, forest: RandomForestClassifier, held: Broadcast):
    """Grow the trees where the cores are and let Spark read them as it reads any stored forest."""
    path, trees = scratch_path(spark, "forest"), forest.getNumTrees()
    slots, by = held.value.slots, rules(forest, held.value)
    tasks = min(trees, spark.sparkContext.defaultParallelism)
    numbers = spark.range(0, trees, 1, tasks)
    numbers.mapInArrow(partial(_grown, found=held, by=by), NODES).write.parquet(f"{path}/data")
    common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    package = "org.apache.spark.ml.classification."
    whole = {
        "class": f"{package}RandomForestClassificationModel", **common, "uid": forest.uid, **_settings(forest),
        "numFeatures": slots, "numClasses": 2, "numTrees": trees,
    }
    each = {
        "class": f"{package}DecisionTreeClassificationModel", **common, "uid": f"dtc_{uuid.uuid4().hex[:12]}",
        **_settings(forest, OF_TREES),
    }
    one = spark.range(0, 1, 1, 1)
    one.select(F.lit(json.dumps(whole)).alias("value")).write.text(f"{path}/metadata")
    spark.range(0, trees, 1, 1).select(
        F.col("id").cast("int").alias("_1"), F.lit(json.dumps(each)).alias("_2"), F.lit(1.0).alias("_3")
    ).write.parquet(f"{path}/treesMetadata")
    # A model of Python would take the one it wraps along when it goes.
    return spark._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel.load(path)


class BaggedForest(RandomForestClassifier):
    """Spark's forest over a table whose equal rows are counted in ``bags``: grown from the counts where it can be."""

    bags: Bags | None = None

    @classmethod
    def of(cls, forest: RandomForestClassifier, bags: Bags) -> BaggedForest:
        made = forest._copyValues(cls())
        made.bags = bags
        return made

    def _fit_java(self, dataset: DataFrame):
        # Spark checks the settings.
        self._transfer_params_to_java()
        held = None if self.bags is None else self.bags.of(self.getMaxBins())
        if held is None:
            return super()._fit_java(dataset)
        return _as_java_model(dataset.sparkSession, self, held)
