"""Feature pipeline: imputed numbers, indexed and one-hot categories, one assembled vector.

Every stage is a Spark ML stage over all columns at once, so fitting takes one job for the means
and one for the categories, whatever the number of columns.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.plans.spec import TableSpec

# Suffixes of the derived columns and the name of the assembled vector.
IMPUTED_SUFFIX = "_IMPUTED"
INDEX_SUFFIX = "_idx"
VECTOR_SUFFIX = "_vec"
FEATURES = "features"
# With more categories than this, an indexer is fitted on the rows.
MOST_LABELS = 1000


def _imputer(columns: Iterable[str]) -> Imputer:
    columns = list(columns)
    return Imputer(
        strategy="mean",
        inputCols=columns,
        outputCols=[c + IMPUTED_SUFFIX for c in columns],
    )


def _indexer(columns: Iterable[str]) -> StringIndexer:
    columns = list(columns)
    return StringIndexer(
        inputCols=columns,
        outputCols=[c + INDEX_SUFFIX for c in columns],
        handleInvalid="keep",
    )


def _encoder(columns: Iterable[str]) -> OneHotEncoder:
    columns = list(columns)
    return OneHotEncoder(
        inputCols=[c + INDEX_SUFFIX for c in columns],
        outputCols=[c + VECTOR_SUFFIX for c in columns],
    )


def impute_mean(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Add ``<c>_IMPUTED``: the column with NULL and NaN replaced by the column's mean."""
    return _imputer(columns).fit(df).transform(df)


def index_categories(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Add ``<c>_idx``: rank by falling frequency, then by value; NULL takes the last index."""
    return _indexer(columns).fit(df).transform(df)


def one_hot(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Add ``<c>_idx`` and ``<c>_vec``; NULL and unseen values give an all-zero vector."""
    columns = list(columns)
    return Pipeline(stages=[_indexer(columns), _encoder(columns)]).fit(df).transform(df)


def assemble(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(df)


def feature_pipeline(spec: TableSpec) -> Pipeline:
    """The feature stages without an estimator."""
    stages: list = []
    inputs: list[str] = []
    if spec.numeric:
        stages.append(_imputer(spec.numeric))
    if spec.categorical:
        stages += [_indexer(spec.categorical), _encoder(spec.categorical)]
        inputs += [c + VECTOR_SUFFIX for c in spec.categorical]
    inputs += [c + IMPUTED_SUFFIX for c in spec.numeric]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return Pipeline(stages=stages)


def _imputer_model(spark: SparkSession, columns: Sequence[str], means: Sequence[float]) -> ImputerModel:
    """The imputer with these means: that of a table with one row."""
    named = (F.lit(mean).alias(c) for c, mean in zip(columns, means))
    return _imputer(columns).fit(spark.range(0, 1, 1, 1).select(*named))


def _indexer_model(
    spark: SparkSession, columns: Sequence[str], labels: Sequence[Sequence[str]]
) -> StringIndexerModel:
    """The indexer with these labels in order. Spark's own way to it takes columns with equally many labels only."""
    gateway = spark.sparkContext._gateway
    arrays = gateway.new_array(gateway.jvm.java.lang.String, len(labels), 0)
    for i, of in enumerate(labels):
        array = gateway.new_array(gateway.jvm.java.lang.String, len(of))
        for j, value in enumerate(of):
            array[j] = value
        arrays[i] = array
    indexer = _indexer(columns)
    java = gateway.jvm.org.apache.spark.ml.feature.StringIndexerModel(indexer.uid, arrays)
    return indexer._copyValues(StringIndexerModel(java))


def fit_without_parts(
    counted: DataFrame, spec: TableSpec, rows: str, part: str, parts: int
) -> list[PipelineModel] | None:
    """The feature stages of a table without each of its parts, then of all of it, from its counted rows.

    ``rows`` holds how many rows each stands for. The means, the categories and their order are those of single
    rows, up to rounding, from three jobs for all parts together. None if there is a column without any number,
    for which the stages have no mean, or with many categories, whose labels take a call each.
    """
    numbers, categories = list(spec.numeric), list(spec.categorical)
    if categories:
        about = counted.agg(*(F.approx_count_distinct(c) for c in categories)).first()
        if sum(about) > MOST_LABELS:
            return None
    known = [F.col(c).cast("double") for c in numbers]
    there = [~F.isnan(x) & x.isNotNull() for x in known]
    sums = [F.sum(F.when(t, x * F.col(rows))) for t, x in zip(there, known)]
    sizes = [F.sum(F.when(t, F.col(rows))) for t in there]
    totals = counted.groupBy(part).agg(*sums, *sizes).collect() if numbers else []
    values: dict[int, list[tuple]] = defaultdict(list)
    if categories:
        cells = F.array(
            *(F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value")) for i, c in enumerate(categories))
        )
        listed = counted.select(part, rows, F.explode(cells).alias("v")).filter("v.value IS NOT NULL")
        for at, place, value, n in listed.groupBy(part, "v.place", "v.value").agg(F.sum(rows)).collect():
            values[place].append((at, value, n))

    def fitted(left_out: int | None) -> PipelineModel | None:
        def used(at: int | None) -> bool:
            return left_out is None or (at is not None and at != left_out)

        stages: list = []
        if numbers:
            of = [row[1:] for row in totals if used(row[0])]
            n = [sum(row[len(numbers) + i] or 0 for row in of) for i in range(len(numbers))]
            if not all(n):
                return None
            means = [sum(row[i] or 0.0 for row in of) / n[i] for i in range(len(numbers))]
            stages.append(_imputer_model(counted.sparkSession, numbers, means))
        if categories:
            labels = []
            for place in range(len(categories)):
                counts: dict[str, int] = defaultdict(int)
                for at, value, n in values[place]:
                    if used(at):
                        counts[value] += n
                # Spark orders equal counts as Java orders strings.
                labels.append(sorted(counts, key=lambda v: (-counts[v], v.encode("utf-16-be", "surrogatepass"))))
            stages.append(_indexer_model(counted.sparkSession, categories, labels))
        # The encoder learns its sizes from the indexer, without a job.
        others = feature_pipeline(spec).getStages()[len(stages) :]
        return Pipeline(stages=[*stages, *others]).fit(counted)

    models = [fitted(at) for at in (*range(parts), None)]
    return None if None in models else models


def build_pipeline(spec: TableSpec, estimator: Estimator) -> Pipeline:
    """Feature stages followed by the estimator."""
    return Pipeline(stages=[*feature_pipeline(spec).getStages(), estimator])


def with_estimator(features: PipelineModel, fitted) -> PipelineModel:
    """One pipeline from fitted feature stages and a model trained on their output."""
    return PipelineModel(stages=[*features.stages, fitted])


def feature_frame(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table with all derived feature columns."""
    return feature_pipeline(spec).fit(df).transform(df)


def feature_slots(df: DataFrame, column: str = FEATURES) -> list[tuple[int, str]]:
    """(slot, name) pairs from the vector's ML attributes; reads the schema only."""
    attributes = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    return sorted(
        (attribute["idx"], attribute["name"])
        for kind in attributes.values()
        for attribute in kind
    )


def slot_sources(df: DataFrame, spec: TableSpec, column: str = FEATURES) -> list[tuple[int, str]]:
    """(slot, source column) pairs: one-hot slots go back to the column they encode."""
    sources = []
    for slot, name in feature_slots(df, column):
        source = next(
            (c for c in spec.numeric if name == c + IMPUTED_SUFFIX), None
        ) or max(
            (c for c in spec.categorical if name.startswith(c + VECTOR_SUFFIX + "_")),
            key=len,
        )
        sources.append((slot, source))
    return sources


def feature_names(df: DataFrame, column: str = FEATURES) -> DataFrame:
    """Slot and name of each feature; one row per vector slot."""
    return df.sparkSession.createDataFrame(feature_slots(df, column), "slot INT, feature STRING")


# A sketch's count may be off by a few times its standard error of 5 %; nearer to the limit than this,
# values are counted.
SKETCH_MARGIN = 0.25


def check_inputs(df: DataFrame, spec: TableSpec, non_negative: bool = False) -> None:
    """Refuse columns that would not fit or not train, in one pass over the used columns.

    Distinct values are only looked at if there is a limit: by a sketch first, and counted exactly in
    columns whose sketch lies near the limit.
    """
    limit = spec.max_categories
    checks = [] if limit is None else [F.approx_count_distinct(c).alias(f"d {c}") for c in spec.categorical]
    if non_negative:
        checks += [F.min(c).alias(f"m {c}") for c in spec.numeric]
    if not checks:
        return
    seen = df.agg(*checks).first().asDict()
    if limit is not None:
        about = {c: seen[f"d {c}"] for c in spec.categorical}
        for c in [c for c, n in about.items() if abs(n - limit) <= SKETCH_MARGIN * limit]:
            about[c] = df.select(c).filter(F.col(c).isNotNull()).distinct().count()
        for c, n in about.items():
            if n > limit:
                raise ValueError(f"column {c} has {n} distinct values, more than max_categories={limit}")
    if non_negative:
        for c in spec.numeric:
            low = seen[f"m {c}"]
            if low is not None and low < 0:
                raise ValueError(f"naive Bayes needs non-negative numbers; {c} goes down to {low}")
