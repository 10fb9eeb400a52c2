"""The six classifiers and how a pipeline with one of them is trained."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from math import inf, isfinite, nextafter

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions.expressions import hash_below, key_hash
from tallygrove.operators.boosting import SecondOrderBoosting, SecondOrderModel, logistic_loss, tree_sql
from tallygrove.operators.features import (
    FEATURES,
    build_pipeline,
    check_inputs,
    feature_pipeline,
    with_estimator,
)
from tallygrove.plans.spec import TableSpec

CLASSIFIERS = {
    "random_forest": RandomForestClassifier,
    "gbt": GBTClassifier,
    "linear_svm": LinearSVC,
    "logistic_regression": LogisticRegression,
    "decision_tree": DecisionTreeClassifier,
    "naive_bayes": NaiveBayes,
}
# Boosted trees of this library, next to Spark's classifiers.
SECOND_ORDER = "second_order"
# Marks the rows that tell boosted trees when to stop.
VALIDATION = "_validation"
# How many equal rows a counted row stands for.
ROWS = "_rows"
# Numbers with more distinct values than this are counted as the nearest of so many quantiles, for trees only:
# they cut a number into ``maxBins`` bins (32) themselves.
LEVELS = 512
# Lets Spark choose the partitions of a cached plan at run time, as it does for any other plan.
ADAPTIVE_CACHE = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
# A cached plan that ends in a shuffle gets at least so many partitions per core: with about one per core
# the last few would run alone, on every pass.
MIN_PARTITIONS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
PARTITIONS_PER_CORE = 3


def make_estimator(
    algorithm: str,
    params: Mapping[str, object] | None = None,
    seed: int = 42,
    label: str = "label",
    spec: TableSpec | None = None,
) -> Estimator:
    """A classifier with its defaults, the given settings, and the seed if it takes one.

    ``spec`` names the columns of the second-order trees, which read them rather than the vector.
    """
    if algorithm == SECOND_ORDER:
        if spec is None:
            raise ValueError(f"{SECOND_ORDER} needs the table's spec")
        estimator: Estimator = SecondOrderBoosting(
            labelCol=label, categoricalCols=list(spec.categorical), numericCols=list(spec.numeric)
        )
    elif algorithm in CLASSIFIERS:
        estimator = CLASSIFIERS[algorithm](labelCol=label, featuresCol=FEATURES)
    else:
        known = sorted([*CLASSIFIERS, SECOND_ORDER])
        raise ValueError(f"unknown algorithm {algorithm}; choose from {known}")
    if estimator.hasParam("seed"):
        estimator.set(estimator.getParam("seed"), seed)
    for name, value in (params or {}).items():
        estimator.set(estimator.getParam(name), value)
    return estimator


def needs_non_negative(estimator: Estimator) -> bool:
    """Whether the estimator refuses negative numbers: all naive Bayes kinds but the Gaussian one."""
    return isinstance(estimator, NaiveBayes) and estimator.getModelType() != "gaussian"


def score_column(algorithm: str) -> str:
    """The column that ranks rows: the SVM has no probability."""
    return "rawPrediction" if algorithm == "linear_svm" else "probability"


def used_columns(df: DataFrame, spec: TableSpec, *others: str) -> DataFrame:
    """Only what training reads, so that the scan and the cache hold nothing else."""
    names = dict.fromkeys([*spec.key, *spec.categorical, *spec.numeric, spec.label, *others])
    return df.select(*(name for name in names if name in df.columns))


@contextmanager
def adaptive_caches(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Let Spark choose the partitions of what is cached meanwhile."""
    settings = {ADAPTIVE_CACHE: "true", **settings}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _persist(df: DataFrame) -> DataFrame:
    least = PARTITIONS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    with adaptive_caches(df.sparkSession, **{MIN_PARTITIONS: str(least)}):
        return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def held(df: DataFrame, spec: TableSpec, *others: str, balance: bool = False) -> Iterator[DataFrame]:
    """The used columns, cached in memory and on disk for as long as the fits need them.

    ``balance`` adds one rebalancing shuffle of those columns, for inputs with few or uneven partitions
    (one big file, a skewed join), which would slow every pass over the cache.
    """
    used = used_columns(df, spec, *others)
    if balance:
        used = used.hint("rebalance")
    used = _persist(used)
    try:
        yield used
    finally:
        used.unpersist()


def draws_rows(estimator: Estimator) -> bool:
    """Whether the estimator draws single rows for every tree, as forests do."""
    return isinstance(estimator, RandomForestClassifier)


def spread_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The same rows dealt evenly over all cores, rows alike next to each other, for fits that visit each row often.

    A forest visits every row once per tree and level. A small file has few partitions, and with one
    only one core works, whatever the cluster. Rows alike take the same ways through the trees, which the
    processor's caches reward.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    return df.repartition(parts).sortWithinPartitions(*spec.categorical, *spec.numeric, spec.label)


def reads_bins(estimator: Estimator) -> bool:
    """Whether the estimator sees a number by its bin alone, as trees do, and bins are not finer than levels."""
    return isinstance(estimator, (DecisionTreeClassifier, GBTClassifier)) and estimator.getMaxBins() <= LEVELS


def can_weigh(estimator: Estimator) -> bool:
    """Whether a row of weight n gives the fit of n equal rows, up to rounding.

    So it is with sums over the rows: naive Bayes, trees, logistic regression without a penalty (which would
    be scaled by deviations). Where single rows are drawn or limited, as in forests, it is not.
    """
    if isinstance(estimator, NaiveBayes):
        return estimator.getModelType() != "gaussian"
    if isinstance(estimator, LogisticRegression):
        return estimator.getRegParam() == 0
    if isinstance(estimator, GBTClassifier) and estimator.getSubsamplingRate() < 1:
        return False
    trees = isinstance(estimator, (DecisionTreeClassifier, GBTClassifier))
    return trees and estimator.getMinInstancesPerNode() == 1


def fit_weighed(estimator: Estimator, counted: DataFrame):
    """Fit on counted rows that have their features; rows to be scored need no column of weights."""
    fitted = estimator.copy().setWeightCol(ROWS).fit(counted)
    fitted.clear(fitted.getParam("weightCol"))
    return fitted


def _levels(data: DataFrame, numeric: Sequence[str]) -> dict[str, tuple[list[float], list[float]]]:
    """(values, cuts between them) of the columns with more than ``LEVELS`` distinct values, by quantiles.

    A cut lies halfway, where a tree that learns from the values has its thresholds, so rows and the values
    that stand for them go the same way. A row on the cut goes with the smaller value.
    """
    if not numeric:
        return {}
    about = data.agg(*(F.approx_count_distinct(c).alias(c) for c in numeric)).first()
    many = [c for c in numeric if about[c] > LEVELS]
    if not many:
        return {}
    shares = [i / (LEVELS - 1) for i in range(LEVELS)]
    levels = {}
    for c, found in zip(many, data.approxQuantile(many, shares, 1 / (4 * LEVELS))):
        values: list[float] = []
        cuts: list[float] = []
        for value in sorted(filter(isfinite, set(found))):
            cut = nextafter((values[-1] + value) / 2, inf) if values else -inf
            if cut <= value:
                values.append(value)
                cuts.append(cut)
        if len(values) > 1:
            levels[c] = values, cuts
    return levels


def _on_levels(data: DataFrame, levels: Mapping[str, tuple[list[float], list[float]]]) -> DataFrame:
    """Numbers replaced by the nearest of their column's values; NULL and NaN stay."""
    if not levels:
        return data
    places = {c: f"_level {c}" for c in levels}
    placed = Bucketizer(
        inputCols=list(places), outputCols=list(places.values()), handleInvalid="keep",
        splitsArray=[[*cuts, inf] for _, cuts in levels.values()],
    ).transform(data)
    nearest = {
        # Rows without a number are in a bucket that no value stands for.
        c: F.coalesce(
            F.get(F.lit(levels[c][0]), F.col(place).cast("int")).cast(data.schema[c].dataType), F.col(c)
        )
        for c, place in places.items()
    }
    return placed.withColumns(nearest).drop(*places.values())


@contextmanager
def counted_rows(data: DataFrame, spec: TableSpec, *others: str) -> Iterator[tuple[DataFrame, bool]]:
    """Equal rows once, with their number as ``ROWS``, and whether their numbers are the rows' own.

    They are not if a column has more than ``LEVELS`` distinct values: then only trees may read them. The
    counted rows are cached for as long as the fits need them.
    """
    levels = _levels(data, spec.numeric)
    names = dict.fromkeys([*spec.categorical, *spec.numeric, spec.label, *others])
    counted = _on_levels(data, levels).groupBy(*names).agg(F.count("*").alias(ROWS))
    with adaptive_caches(data.sparkSession):
        counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield counted, not levels
    finally:
        counted.unpersist()


def marked_for_validation(df: DataFrame, spec: TableSpec, rate: float, seed: int = 42) -> DataFrame:
    """Add the validation mark for a share of the rows, by a hash that splits and folds do not use."""
    key = spec.key or tuple(df.columns)
    return df.withColumn(VALIDATION, hash_below(key_hash([*key, *key], seed), rate))


def watch_validation(estimator: Estimator) -> bool:
    """Let boosted trees stop by the marked rows; False for algorithms that have no rounds."""
    if not estimator.hasParam("validationIndicatorCol"):
        return False
    estimator.set(estimator.getParam("validationIndicatorCol"), VALIDATION)
    return True


def round_losses(
    model: PipelineModel, parts: Mapping[str, DataFrame], label: str = "label"
) -> DataFrame:
    """(round, part, loss): mean logistic loss on each part after each round of boosted trees.

    One pass per part for second-order trees; Spark's trees are walked by Spark.
    """
    fitted, features = model.stages[-1], PipelineModel(stages=model.stages[:-1])
    spark = next(iter(parts.values())).sparkSession
    if isinstance(fitted, GBTClassificationModel):
        rows = []
        for part, df in parts.items():
            # Spark's loss of a margin m is 2 log(1 + exp(-2 y m)), twice that of the log-odds 2 m.
            losses = fitted.evaluateEachIteration(features.transform(df))
            rows += [(i, part, loss / 2) for i, loss in enumerate(losses, start=1)]
        return spark.createDataFrame(rows, "round INT, part STRING, loss DOUBLE")
    if not isinstance(fitted, SecondOrderModel):
        raise ValueError("only boosted trees have rounds")
    trees = [F.expr(tree_sql(tree, False)) for tree in fitted.nodes()]
    tables = []
    for part, df in parts.items():
        values = df.select(F.col(label).alias("_label"), *(t.alias(f"_t{i}") for i, t in enumerate(trees)))
        margins, total = [], F.lit(0.0)
        for i in range(len(trees)):
            total = total + F.col(f"_t{i}")
            margins.append(F.avg(logistic_loss(total, F.col("_label"))))
        listed = values.agg(F.array(*margins).alias("_losses"))
        tables.append(
            listed.select(F.posexplode("_losses").alias("round", "loss")).select(
                (F.col("round") + 1).alias("round"), F.lit(part).alias("part"), "loss"
            )
        )
    return reduce(DataFrame.unionByName, tables)


def _can_count(estimator: Estimator, spec: TableSpec) -> bool:
    """Whether counted rows give the same fit: a linear model whose loss is a sum over the rows alone.

    A penalty would be scaled by deviations, for which a row of weight n is not n rows. With numbers among
    the columns, rows are rarely equal.
    """
    linear = isinstance(estimator, (LinearSVC, LogisticRegression))
    return linear and bool(spec.categorical) and not spec.numeric and estimator.getRegParam() == 0


def _fit_counted(data: DataFrame, spec: TableSpec, estimator: Estimator) -> PipelineModel:
    """Fit a linear model on categories alone: iterations go over the combinations that occur, counted.

    The feature stages are fitted on the rows themselves, as the order of a column's values needs them.
    """
    features = feature_pipeline(spec).fit(data)
    with counted_rows(data, spec) as (counted, _):
        return with_estimator(features, fit_weighed(estimator, features.transform(counted)))


def train(
    df: DataFrame,
    spec: TableSpec,
    algorithm: str = "random_forest",
    params: Mapping[str, object] | None = None,
    seed: int = 42,
    balance: bool = False,
    validation_rate: float | None = None,
) -> PipelineModel:
    """Fit feature stages and classifier on a prepared table; ``balance`` as in ``held``.

    With ``validation_rate``, boosted trees do not learn from that share of the rows: the loss on them
    ends the fit, and the rounds after the best one are cut off. The feature stages use all rows.

    Linear models without a penalty on categories alone go over counted combinations of categories.
    """
    estimator = make_estimator(algorithm, params, seed, spec.label, spec)
    marks = ()
    if validation_rate is not None:
        if not watch_validation(estimator):
            raise ValueError(f"{algorithm} has no rounds to stop")
        df, marks = marked_for_validation(df, spec, validation_rate, seed), (VALIDATION,)
    with held(df, spec, *marks, balance=balance) as data:
        check_inputs(data, spec, needs_non_negative(estimator))
        if _can_count(estimator, spec):
            return _fit_counted(data, spec, estimator)
        return build_pipeline(spec, estimator).fit(data)
