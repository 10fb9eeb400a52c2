"""Column expressions. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 16**8


def substring_flag(column: str, needle: str) -> Column:
    """1 where the text contains the needle, else 0; a NULL text gives 0."""
    return F.when(F.col(column).contains(needle), F.lit(1)).otherwise(F.lit(0))


def without_sentinel(column: str, sentinel: str, value: str) -> Column:
    """The column with an exact sentinel text replaced; NULL stays NULL."""
    return F.when(F.col(column) == sentinel, F.lit(value)).otherwise(F.col(column))


def key_hash(key: Sequence[str], seed: int) -> Column:
    """32 hex digits that depend only on the key and the seed, never on the partitioning."""
    parts = [F.col(name).cast("string") for name in key]
    return F.md5(F.concat_ws("-", *parts, F.lit(str(seed))))


def hash_below(digest: Column, rate: float) -> Column:
    """True for the share ``rate`` of the hash space, by the first eight hex digits."""
    cut = int(rate * HASH_SPACE)
    if cut >= HASH_SPACE:
        return F.lit(True)
    return F.substring(digest, 1, 8) < F.lit(format(cut, "08x"))


def hash_modulo(digest: Column, n: int) -> Column:
    """A number in [0, n) from digits 9-16, so that it is independent of ``hash_below``."""
    return (F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint") % n).cast("int")


def by_class(label: str, values: Mapping[object, Column], default: Column) -> Column:
    """One expression per class of the label column."""
    chosen = default
    for value, column in values.items():
        chosen = F.when(F.col(label) == F.lit(value), column).otherwise(chosen)
    return chosen


def class_score(vector: str, index: int = 1) -> Column:
    """One element of a score vector."""
    return vector_to_array(F.col(vector)).getItem(index)
