"""Cutting lineage: intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrove.sources.scratch import saved_table, scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back with known size."""
    return saved_table(df, name)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, for the short tables of loops; Spark removes it when it is unused."""
    spark: SparkSession = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        set_to = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(set_to or scratch_path(spark, "checkpoints"))
    return df.checkpoint()


def _comparable(value: Column, kind: T.DataType) -> Column:
    """The value with every map in it as its entries in order, as maps have no hash."""
    if not _holds_map(kind):
        return value
    if isinstance(kind, T.MapType):
        entries = T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]))
        return F.array_sort(F.transform(F.map_entries(value), lambda e: _comparable(e, entries.elementType)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _comparable(e, kind.elementType))
    fields = [_comparable(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
    return F.when(value.isNotNull(), F.struct(*fields))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def row_key(df: DataFrame | Sequence[str]) -> list[Column]:
    """Two hashes over all columns that tell different rows apart and equal rows not.

    Maps are equal if their entries are, in whatever order. Of a table without maps the names alone will do.
    """
    if isinstance(df, DataFrame):
        every = [F.col(f"`{c}`") for c in df.columns]
        values = [_comparable(c, f.dataType) for c, f in zip(every, df.schema.fields)]
    else:
        values = every = [F.col(f"`{c}`") for c in df]
    return [
        F.xxhash64(F.lit(1), *values, *(c.isNull() for c in every)).alias("_key1"),
        F.xxhash64(F.lit(2), *values, *(c.isNull() for c in every)).alias("_key2"),
    ]


def packed(df: DataFrame, *more: Column | str) -> DataFrame:
    """All columns as one struct ``_row``, so that no name of the table can clash, and ``more``."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), *more)


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores added until no column has it (upper and lower case are one)."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name
