"""Splits and folds.

Apart from ``random_split``, every function decides on a hash of the row key, so the result does
not change with the partitioning, the number of executors or a re-run of a lost task. Rows with
equal keys always land on the same side, but for ``deal_split``, which deals the copies of a row out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.expressions import HASH_SPACE, by_class, hash_below, hash_modulo, key_hash
from tallygrove.sources.scratch import saved_table


def _digest(df: DataFrame, key: Sequence[str], seed: int) -> Column:
    return key_hash(tuple(key) or tuple(df.columns), seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own random split; depends on the partitioning of ``df``."""
    return df.randomSplit(list(weights), seed=seed)


def in_train(df: DataFrame, key: Sequence[str], rate: float, seed: int) -> Column:
    """The predicate behind ``hash_split``."""
    return hash_below(_digest(df, key, seed), rate)


def hash_split(
    df: DataFrame, key: Sequence[str], rate: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint filters; no shuffle."""
    inside = in_train(df, key, rate, seed)
    return df.filter(inside), df.filter(~inside)


def deal_split(
    df: DataFrame, rate: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split a table without a key so that copies of a row go to both sides in the ratio of ``rate``.

    ``hash_split`` without a key hashes whole rows, so all copies of a row land on one side. Here equal
    rows are counted, which needs one shuffle of counts, and copy number k of a row is inside if
    ``k * rate``, shifted by a hash of the row, passes a whole number at it. Of n copies the first side
    gets ``n * rate`` to within one, and a single row is inside with probability ``rate``. The outcome
    depends on the rows alone. A row of very many copies is cut into blocks that different tasks write
    out; no task ranks its copies. All rows are kept, NULL equals NULL.
    """
    dealt = _dealt_blocks(df, rate, seed)
    return tuple(_copies(dealt, df.columns, side) for side in ("_inside", "_outside"))


# Copies of a row that one task writes out at a time.
BLOCK = 100_000


def _dealt_blocks(df: DataFrame, rate: float, seed: int) -> DataFrame:
    """The distinct rows as ``_row``, once per block of copies, with how many go to either side."""
    if not 0.0 <= rate <= 1.0:
        raise ValueError("the rate must lie between 0 and 1")
    # JSON names NULL fields by their absence and keeps texts apart that a plain separator would join.
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)))
    counted = df.select(row.alias("_row")).groupBy("_row").agg(F.count("*").alias("_n"))
    digest = F.md5(F.concat_ws("-", F.to_json("_row"), F.lit(str(seed))))
    shift = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / HASH_SPACE

    def passed(copies: Column) -> Column:
        return F.floor(copies * F.lit(float(rate)) + F.col("_shift")).cast("bigint")

    blocks = (
        counted.withColumn("_shift", shift)
        .withColumn("_start", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(BLOCK))))
        .withColumn("_end", F.least(F.col("_n"), F.col("_start") + BLOCK))
        .withColumn("_inside", passed(F.col("_end")) - passed(F.col("_start")))
        .withColumn("_outside", F.col("_end") - F.col("_start") - F.col("_inside"))
    )
    single = blocks.filter(F.col("_n") <= BLOCK)
    # Blocks of one row lie in one task after counting.
    many = blocks.filter(F.col("_n") > BLOCK).repartition(F.xxhash64("_shift", "_start"))
    return single.unionByName(many)


def _copies(blocks: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    copies = blocks.filter(F.col(side) > 0).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col(side).cast("int")))
    )
    return copies.select(*(F.col(f"_row.c{i}").alias(c) for i, c in enumerate(columns)))


def assign_part(
    df: DataFrame, key: Sequence[str], ratios: Sequence[float], seed: int, column: str = "part"
) -> DataFrame:
    """Number the parts 0..n of an n-way split; the last part takes the rest of the hash space."""
    digest = _digest(df, key, seed)
    cuts, total = [], 0.0
    for ratio in ratios:
        total += ratio
        cuts.append(total)
    if total > 1.0 + 1e-9:
        raise ValueError("the ratios add up to more than 1")
    if cuts and total > 1.0 - 1e-9:
        cuts[-1] = 1.0  # the sum of the ratios may miss 1 by a rounding error
    part = F.lit(len(cuts))
    for number in range(len(cuts) - 1, -1, -1):
        part = F.when(hash_below(digest, cuts[number]), F.lit(number)).otherwise(part)
    return df.withColumn(column, part)


def hash_split_n(
    df: DataFrame, key: Sequence[str], ratios: Sequence[float], seed: int = 42
) -> list[DataFrame]:
    """One filter per ratio, then one for what the ratios leave over."""
    numbered = assign_part(df, key, ratios, seed, "_part")
    return [
        numbered.filter(F.col("_part") == number).drop("_part")
        for number in range(len(ratios) + 1)
    ]


def assign_fold(
    df: DataFrame, key: Sequence[str], n: int = 5, seed: int = 42, column: str = "fold"
) -> DataFrame:
    """Cross-validation fold 0..n-1 of each row."""
    return df.withColumn(column, hash_modulo(_digest(df, key, seed), n))


def sample_by(
    df: DataFrame,
    label: str,
    fractions: Mapping[object, float],
    key: Sequence[str],
    seed: int = 42,
) -> DataFrame:
    """Keep a share of each class; classes without a share are left out."""
    digest = _digest(df, key, seed)
    kept = {value: hash_below(digest, share) for value, share in fractions.items()}
    return df.filter(by_class(label, kept, F.lit(False)))


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], frac: float, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """The first ``floor(frac * n)`` rows of each class in hash order, and the others.

    Ranking a class would sort it in one task. Instead the cut is found by hash prefix: count the
    rows per class and prefix (at most 65,536 prefixes a class), walk to the prefix that holds the
    cut, and look closer only at the rows inside it. The cuts are a table with a row per class, however
    many there are, and the split joins it. Rows without a class are among the others.
    """
    digest = _digest(df, key, seed)
    cuts = _hash_cuts(df.select(F.col(label).alias("_class"), digest.alias("_hash")), frac)
    joined = df.join(cuts, df[label] == cuts["_class"], "left")
    inside = F.coalesce(digest <= cuts["_prefix"], F.lit(False))
    return (
        joined.filter(inside).select(*(df[c] for c in df.columns)),
        joined.filter(~inside).select(*(df[c] for c in df.columns)),
    )


def _hash_cuts(hashed: DataFrame, frac: float) -> DataFrame:
    """(class, prefix): the largest hash to take from each class so that its share of rows is taken."""
    counts = _by_prefix(hashed.filter(F.col("_class").isNotNull()), 4)
    whole = Window.partitionBy("_class")
    need = F.floor(F.lit(frac) * F.sum("_n").over(whole))
    cuts = _kept(_cut_rows(counts.withColumn("_need", need)))
    held = _within(hashed, cuts, 4).persist(StorageLevel.MEMORY_AND_DISK)
    near = held
    try:
        for digits in (8, 32):
            need = cuts.select("_class", F.col("_take").alias("_need"))
            cuts = _kept(_cut_rows(_by_prefix(near, digits).join(need, "_class")))
            near = _within(near, cuts, digits)
    finally:
        held.unpersist()
    return cuts.select("_class", "_prefix")


def _kept(cuts: DataFrame) -> DataFrame:
    """A row per class, computed once; its size then tells Spark how to join it."""
    return saved_table(cuts, "cuts")


def _within(hashed: DataFrame, cuts: DataFrame, digits: int) -> DataFrame:
    """The rows that share the cut's prefix."""
    own = cuts.select("_class", F.col("_prefix").alias("_cut"))
    joined = hashed.join(own, "_class")
    return joined.filter(F.substring("_hash", 1, digits) == F.col("_cut")).select("_class", "_hash")


def _by_prefix(hashed: DataFrame, digits: int) -> DataFrame:
    """Rows per class and hash prefix, with the running total of the class."""
    in_order = Window.partitionBy("_class").orderBy("_prefix")
    return (
        hashed.groupBy("_class", F.substring("_hash", 1, digits).alias("_prefix"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(in_order))
    )


def _cut_rows(counts: DataFrame) -> DataFrame:
    """Per class, the prefix that holds row number ``_need``, and how many of its rows to take."""
    before = F.col("_upto") - F.col("_n")
    return counts.filter((before < F.col("_need")) & (F.col("_need") <= F.col("_upto"))).select(
        "_class", "_prefix", (F.col("_need") - before).alias("_take")
    )
