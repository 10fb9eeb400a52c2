"""Cleaning: drop columns, derive the label, replace missing-value markers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.functions.expressions import substring_flag, without_sentinel
from tallygrove.plans.spec import TableSpec


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def binary_label(df: DataFrame, column: str, needle: str, label: str = "label") -> DataFrame:
    """Add a 0/1 label: 1 where ``column`` contains ``needle``."""
    return df.withColumn(label, substring_flag(column, needle))


def replace_sentinel(
    df: DataFrame, columns: Iterable[str], sentinel: str = " ?", value: str = "NA"
) -> DataFrame:
    return df.withColumns({c: without_sentinel(c, sentinel, value) for c in columns})


def feature_columns(df: DataFrame, label: str) -> list[str]:
    """Every column but the label; reads the schema only."""
    return [name for name in df.columns if name != label]


def as_category(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn columns into text so that the indexer treats their values as categories."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def prepare(df: DataFrame, spec: TableSpec, with_label: bool = True) -> DataFrame:
    """The cleaning chain in one projection.

    The label is left out when ``with_label`` is false or the table has no label source, so tables
    to be scored need not carry one.
    """
    removed = {*spec.dropped, spec.label_source}
    marked = set(spec.sentinel_columns)
    kept = []
    for name in df.columns:
        if name in removed:
            continue
        if name in marked:
            kept.append(
                without_sentinel(name, spec.sentinel, spec.sentinel_value).alias(name)
            )
        else:
            kept.append(F.col(name))
    if with_label and spec.label_source is not None:
        kept.append(substring_flag(spec.label_source, spec.positive_marker).alias(spec.label))
    return df.select(*kept)
