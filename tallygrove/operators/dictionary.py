"""Categories as a table: a dictionary of any number of values, applied by a join.

``features.index_categories`` keeps every value in the fitted model, and with it on the driver and in
the plan. Here the values stay in a table with a row each; the driver holds one number per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallygrove.operators.features import INDEX_SUFFIX, VECTOR_SUFFIX
from tallygrove.sources.scratch import saved_table, scratch_path

DICTIONARY_SCHEMA = "column STRING, value STRING, n BIGINT, index BIGINT"
# ``monotonically_increasing_id`` counts a partition's rows in its lower bits.
PLACE_BITS = 33
# Fixed value: the tag that marks a vector as sparse in its stored form.
SPARSE = 0


@dataclass(frozen=True)
class CategoryDictionary:
    """The stored table and the number of values of each column."""

    path: str
    table: DataFrame
    sizes: dict[str, int]

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.sizes)

    def of(self, column: str) -> DataFrame:
        return self.table.filter(F.col("column") == column).select("value", "index")


def category_dictionary(
    df: DataFrame, columns: Iterable[str], path: str | None = None
) -> CategoryDictionary:
    """Index the values of each column by falling frequency, then by value; NULL is no value.

    The values are counted in one pass and sorted by ranges of (column, count, value), so a count that
    very many values share is spread over tasks like any other. A value's index is its place in its own
    range plus the values of its column in earlier ranges, of which there is one number per range and
    column: no window sees the values. Values are compared as text, in the order of their UTF-8 bytes.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        raise ValueError("a dictionary needs at least one column")
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    # Written once: the places are those of the written rows, also if a later task has to run again.
    placed = saved_table(
        counts.orderBy("column", F.desc("n"), "value").withColumn(
            "_place", F.monotonically_increasing_id()
        ),
        "categories",
    ).withColumn("_range", F.shiftright("_place", PLACE_BITS))
    earlier = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("column", "_range")
        .agg(F.count("*").alias("_held"), F.min("_place").alias("_first"))
        .select(
            "column",
            "_range",
            (F.coalesce(F.sum("_held").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        )
    )
    indexed = placed.join(starts, ["column", "_range"]).select(
        "column", "value", "n", (F.col("_place") + F.col("_shift")).alias("index")
    )
    path = path or scratch_path(df.sparkSession, "dictionary")
    indexed.write.parquet(path)
    return load_dictionary(df.sparkSession, path, columns)


def load_dictionary(spark: SparkSession, path: str, columns: Sequence[str]) -> CategoryDictionary:
    """The dictionary stored at ``path``; a column without any value has size 0."""
    table = spark.read.schema(DICTIONARY_SCHEMA).parquet(path)
    held = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return CategoryDictionary(path, table, {c: held.get(c, 0) for c in columns})


def _others(df: DataFrame, name: str) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c != name]


def _free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until the table has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while taken & {n.lower() for n in names}:
        names = tuple("_" + n for n in names)
    return list(names)


def index_by_dictionary(
    df: DataFrame, dictionary: CategoryDictionary, columns: Iterable[str] | None = None
) -> DataFrame:
    """Add ``<c>_idx`` as ``index_categories`` does; NULL and unknown values take the last index.

    One left join a column. Spark broadcasts a small dictionary by its size on disk and otherwise splits
    the table's skewed partitions, which a left join allows, so a value of very many rows is no hot task.
    """
    for c in dictionary.columns if columns is None else columns:
        value, place = _free_names(df, "value", "index")
        own = dictionary.of(c).toDF(value, place)
        joined = df.join(own, F.col(f"`{c}`").cast("string") == F.col(value), "left")
        index = F.coalesce(place, F.lit(dictionary.sizes[c])).cast("double")
        df = joined.select(*_others(df, c + INDEX_SUFFIX), index.alias(c + INDEX_SUFFIX))
    return df


def _indicator(index: Column, size: int) -> Column:
    """A sparse vector with a one at ``index``, or of zeros if the index is ``size``.

    Spark has no SQL function that makes a sparse vector, but reads the stored form of one from text.
    """
    known = index < size
    stored = F.struct(
        F.lit(SPARSE).alias("type"),
        F.lit(size).alias("size"),
        F.when(known, F.array(index.cast("int"))).otherwise(F.array().cast("array<int>")).alias("indices"),
        F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )
    shape = StructType([StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(stored.alias("v"))), shape)["v"]


def one_hot_by_dictionary(
    df: DataFrame, dictionary: CategoryDictionary, columns: Iterable[str] | None = None
) -> DataFrame:
    """Add ``<c>_idx`` and ``<c>_vec`` as ``one_hot`` does, but with the slots' number as the only attribute."""
    columns = list(dictionary.columns if columns is None else columns)
    df = index_by_dictionary(df, dictionary, columns)
    for c in columns:
        size = dictionary.sizes[c]
        vector = _indicator(F.col(f"`{c}{INDEX_SUFFIX}`"), size)
        named = vector.alias(c + VECTOR_SUFFIX, metadata={"ml_attr": {"num_attrs": size}})
        df = df.select(*_others(df, c + VECTOR_SUFFIX), named)
    return df
