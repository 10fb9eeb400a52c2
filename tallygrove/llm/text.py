"""Text kernels that the operators share: many texts as one array of code points, hashed n-grams,
bounded samples of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts are handled in runs of about this many characters, so temporary arrays stay small.
RUN_CHARS = 250_000
# Blanks after every text, so that no n-gram reaches into the next one.
GAP = 4


def whole(texts: pd.Series) -> list[str]:
    """The texts of an Arrow batch; null counts as empty."""
    return [t if isinstance(t, str) else "" for t in texts]


def runs(texts: Sequence[str], most: int = RUN_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together; a longer text is a run of its own."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text) + GAP
    if part:
        yield part


@dataclass
class Points:
    """Code points of several texts with where each begins and ends."""

    codes: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def points(texts: Sequence[str]) -> Points:
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    gap = " " * GAP
    joined = gap.join(texts) + gap
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.concatenate([[0], np.cumsum(sizes + GAP)[:-1]]) if len(texts) else sizes
    return Points(codes, begins, begins + sizes)


def span_sums(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[begin:end]`` per span; spans are in order and the last ends inside."""
    if not len(begins):
        return np.zeros((0, *values.shape[1:]), values.dtype)
    edges = np.column_stack([begins, ends]).ravel()
    sums = np.add.reduceat(values, edges, axis=0)[::2]
    sums[begins == ends] = 0
    return sums


def mixed(h: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of 32-bit hashes."""
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h >>= np.uint32(32 - bits)
    return h


def char_grams(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each place; the last ``n - 1`` are of no use."""
    h = np.zeros(len(codes), np.uint32)
    factor = 0x9E3779B1
    for i in range(n):
        h[: len(codes) - i] += codes[i:] * np.uint32(factor)
        factor = factor * 0x85EBCA6B & 0xFFFFFFFF
    return mixed(h, bits)


_POWERS = np.array([pow(0x5851F42D4C957F2D, i + 1, 1 << 64) for i in range(256)], np.uint64)


@dataclass
class Words:
    """Hash and place of each word; word ``i`` begins at code point ``begins[i]``."""

    hashes: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def is_blank(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def words_of(codes: np.ndarray, blank: np.ndarray) -> Words:
    """The maximal stretches without a blank; ``codes`` ends with one."""
    inside = ~blank
    edges = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(begins):
        return Words(np.zeros(0, np.uint64), begins, ends)
    sizes = ends - begins
    own = codes[inside].astype(np.uint64)
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(len(own)) - np.repeat(firsts, sizes)
    own += np.uint64(0x632BE5AB)
    own *= _POWERS[place & 255]
    own ^= own >> np.uint64(29)
    hashes = np.add.reduceat(own, firsts)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(31)
    return Words(hashes, begins, ends)


@cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def labelled_sample(
    rows: DataFrame, key: str, label: str, per_class: int, seed: int = 42
) -> DataFrame:
    """About ``per_class`` rows of each label value, chosen by a hash of the key.

    Only counts per label value reach the driver. Which rows are taken does not depend on how they
    are partitioned. A class with fewer rows is taken whole.
    """
    known = rows.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, label)
    counts = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    space = 1 << 30
    taken = F.lit(False)
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(space))
    for value, count in sorted(counts.items()):
        share = min(space, int(space * per_class / count))
        taken = taken | ((F.col(label) == F.lit(value)) & (place < F.lit(share)))
    return known.filter(taken)


def crc_remainder(key: str | Column, modulus: int) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string") if isinstance(key, str) else key), modulus)


def bounded_batches(df: DataFrame, most: int = 8 << 20) -> None:
    """Let no Arrow batch of the session grow beyond ``most`` bytes of text."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(conf.get(name)).rstrip("bB")) > most:
        conf.set(name, str(most))
