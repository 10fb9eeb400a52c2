"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, one line per component.

Every line with at least ``SHINGLE`` characters gets ``MINIMA`` minima over hashes of its character
shingles, computed where the text is read; each of ``BANDS`` bands takes ``ROWS`` of them. One changed
character touches as many shingles as a shingle has characters, so longer shingles would miss short lines
after one edit. Lines that agree in a whole band share a bucket: long bands keep unrelated lines apart,
many bands bring a pair at a similarity of exactly 0.8 together with a probability of 99.8 %, one at 0.85
with 99.99 %.

(bucket, line) entries travel packed, as one array per part of the buckets, and a task sorts one part at a
time. It holds about ``HELD`` entries: buckets that have grown large by then are passed on as they come.
Buckets with the same members are one. The texts of lines in shared buckets, and only those, are fetched,
and within a bucket the exact Jaccard similarity of the shingle sets decides; a pair that is already
connected needs no comparison, so only a spanning forest leaves the task. Buckets beyond ``BUCKET_LINES``
are cut into parts and every pair of parts is a task. Components come from ``components``; of each the
first line stays, in the order of document id, row and line number.

Shorter lines are duplicates only when they are equal. Lines without a visible character (blanks only)
always stay. A null text has no line. A very long line is hashed by itself. Rows that are equal in all
columns count as one row, so each appears once in the result. A null ``doc_id`` comes after all others. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.components import star_forest
from tallygrove.llm.tables import packed, row_key, saved
from tallygrove.llm.text import bounded_batches, points, runs, whole

SHINGLE = 5
MINIMA, BANDS, ROWS = 96, 24, 6
LEAST = 0.8
# Characters that are hashed together; the arrays of that many stay in a core's cache.
CHARS = 75_000
BUCKET_LINES = 500
BUCKET_CHARS = 2_000_000
# Entries are a bucket and a line. A part of the buckets is meant to have ``PART_ENTRIES``, a task packs
# ``PACKED`` at a time, holds ``HELD`` of a part and then passes on buckets of more than ``LARGE`` lines.
PART_ENTRIES = 2_000_000
PACKED = 1_000_000
HELD = 4_000_000
LARGE = 1_000
ENTRY = np.dtype([("bucket", "<u4"), ("h1", "<i8")])

_DRAW = np.random.default_rng(11)
_FACTORS = _DRAW.integers(0, 1 << 32, MINIMA // 2, np.uint32) | np.uint32(1)
# Bands out of one order of the minima share none.
_ORDERS = -(-BANDS // (MINIMA // ROWS))
_BAND_MINIMA = np.concatenate(
    [_DRAW.permutation(MINIMA)[: MINIMA // ROWS * ROWS].reshape(-1, ROWS) for _ in range(_ORDERS)]
)[:BANDS]
_BAND_SEEDS = _DRAW.integers(0, 1 << 63, (BANDS, 1), np.uint64)


def _hashes(codes: np.ndarray, shingle: int) -> np.ndarray:
    """The 32-bit hash of the shingle that begins at each place.

    Hashes of 2, 4, 8 ... characters come from two of the one before; then one character at a time.
    """
    own = codes * np.uint32(0x85EBCA6B)
    h, width = own, 1
    while width < shingle:
        step = width if 2 * width <= shingle else 1
        more = h if step == width else own
        h = h[: len(h) - step] * np.uint32(0xC2B2AE35) + more[width:]
        h ^= h >> np.uint32(15)
        width += step
    h *= np.uint32(0x27D4EB2F)
    h ^= h >> np.uint32(13)
    return h


def signatures(lines: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """One 64-bit number per band for each line; the lines have at least ``shingle`` characters."""
    p = points(lines)
    h = _hashes(p.codes, shingle)
    edges = np.column_stack([p.begins, p.ends - shingle + 1]).ravel()
    least, product = np.empty((MINIMA, len(lines)), np.uint64), np.empty_like(h)
    for i, factor in enumerate(_FACTORS):
        np.multiply(h, factor, out=product)
        # The largest product is as good a draw as the smallest one.
        least[2 * i] = np.minimum.reduceat(product, edges)[::2]
        least[2 * i + 1] = np.maximum.reduceat(product, edges)[::2]
    bands = np.repeat(_BAND_SEEDS, len(lines), axis=1)
    for row in range(ROWS):
        bands ^= least[_BAND_MINIMA[:, row]]
        bands *= np.uint64(0xBF58476D1CE4E5B9)
        bands ^= bands >> np.uint64(31)
    return np.ascontiguousarray(bands.T).view(np.int64)


def _packed_entries(bands: list[np.ndarray], h1: list[np.ndarray], parts: int) -> pd.DataFrame:
    """One row per part of the buckets with the entries of all these lines in it."""
    values = np.concatenate(bands).view(np.uint64).ravel()
    part = ((values >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part)
    entries = np.empty(len(values), ENTRY)
    entries["bucket"] = values.astype(np.uint32)[order]
    entries["h1"] = np.repeat(np.concatenate(h1), BANDS)[order]
    part = part[order]
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    cut = np.split(entries, begins[1:])
    return pd.DataFrame({"part": part[begins], "entries": [e.tobytes() for e in cut]})


def _dealt(batches: Iterator[pd.DataFrame], shingle: int, parts: int) -> Iterator[pd.DataFrame]:
    bands: list[np.ndarray] = []
    h1: list[np.ndarray] = []
    for batch in batches:
        batch = batch.drop_duplicates("h1")
        bands += [signatures(run, shingle) for run in runs(whole(batch["line"]), CHARS)]
        h1.append(batch["h1"].to_numpy(np.int64))
        if sum(map(np.size, bands)) >= PACKED:
            yield _packed_entries(bands, h1, parts)
            bands, h1 = [], []
    if bands:
        yield _packed_entries(bands, h1, parts)


def _lines(documents: DataFrame, *more: Column | str) -> DataFrame:
    """A row per line that is not blank: number, text and two hashes."""
    split = documents.select(*more, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    visible = split.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return visible.select(
        "*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")
    )


def _runs_of(sorted_values: np.ndarray) -> np.ndarray:
    """For each value how often it occurs."""
    begins = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    sizes = np.diff(np.append(begins, len(sorted_values)))
    return np.repeat(sizes, sizes)


def _named(bucket: np.ndarray, h1: np.ndarray) -> pd.DataFrame:
    """The entries of whole, sorted buckets, each bucket named by a hash of its members."""
    begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    h = h1.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    names = np.add.reduceat(h, begins).view(np.int64)
    return pd.DataFrame({"bucket": np.repeat(names, np.diff(np.append(begins, len(bucket)))), "h1": h1})


def _distinct(entries: np.ndarray) -> np.ndarray:
    """The entries in order, each once."""
    entries = entries[np.lexsort((entries["h1"], entries["bucket"]))]
    bucket, h1 = entries["bucket"], entries["h1"]
    return entries[np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (h1[1:] != h1[:-1])])[: len(entries)]]


class _Part:
    """Entries of one part of the buckets, as they come."""

    def __init__(self, number: int):
        self.number = number
        self.held: list[np.ndarray] = []
        self.size, self.most = 0, HELD
        self.passed = np.zeros(0, np.uint32)  # buckets whose lines are passed on at once

    def take(self, entries: np.ndarray) -> Iterator[pd.DataFrame]:
        self.held.append(entries)
        self.size += len(entries)
        if self.size < self.most:
            return
        held = _distinct(np.concatenate(self.held))
        bucket = held["bucket"]
        large = (_runs_of(bucket) > LARGE) | np.isin(bucket, self.passed)
        self.passed = np.union1d(self.passed, bucket[large])
        yield from self._pass_on(held[large])
        self.held, self.size = [held[~large]], int((~large).sum())
        self.most = max(HELD, 2 * self.size)

    def rest(self) -> Iterator[pd.DataFrame]:
        """Members of the remaining buckets with two or more lines."""
        held = np.concatenate(self.held)
        held = held[np.argsort(held["bucket"])]
        known = np.isin(held["bucket"], self.passed)
        yield from self._pass_on(held[known])
        held = held[~known]
        # Most buckets have one line; only the others are worth a sort by line.
        if len(held):
            held = held[_runs_of(held["bucket"]) > 1]
        held = _distinct(held)
        if len(held):
            held = held[_runs_of(held["bucket"]) > 1]
        if len(held):
            yield _named(np.ascontiguousarray(held["bucket"]), np.ascontiguousarray(held["h1"]))

    def _pass_on(self, entries: np.ndarray) -> Iterator[pd.DataFrame]:
        if len(entries):
            name = (np.uint64(self.number) << np.uint64(32)) + entries["bucket"].astype(np.uint64)
            name *= np.uint64(0x9E3779B97F4A7C15)
            yield pd.DataFrame({"bucket": name.view(np.int64), "h1": entries["h1"]})


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of buckets with two or more lines; rows come sorted by part."""
    own = None
    for batch in batches:
        for number, entries in zip(batch["part"], batch["entries"]):
            if own is None or number != own.number:
                if own is not None:
                    yield from own.rest()
                own = _Part(number)
            yield from own.take(np.frombuffer(entries, ENTRY))
    if own is not None:
        yield from own.rest()


def shingle_sets(lines: list[str], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each line's shingles as sorted, distinct 64-bit hashes."""
    for run in runs(lines, CHARS):
        p = points(run)
        codes = p.codes.astype(np.uint64)
        h = np.zeros(len(codes) - shingle + 1, np.uint64)
        for i in range(shingle):
            h += codes[i : len(codes) - shingle + 1 + i]
            h *= np.uint64(0x5851F42D4C957F2D)
            h ^= h >> np.uint64(33)
        edges = list(zip(p.begins.tolist(), (p.ends - shingle + 1).tolist()))
        for begin, end in edges:
            h[begin:end].sort()
        new = np.concatenate([[True], h[1:] != h[:-1]])
        new[p.begins] = True
        for begin, end in edges:
            yield h[begin:end][new[begin:end]]


def _near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is at least ``LEAST``."""
    if min(len(a), len(b)) < LEAST * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = np.count_nonzero(both[1:] == both[:-1])
    return common >= LEAST * (len(both) - common) - 1e-9


class _Bucket:
    """Links of one bucket, or between two parts of a large one, as a spanning forest."""

    def __init__(self, one_part: bool):
        self.one_part = one_part
        self.groups: list[list[tuple[int, np.ndarray, bool]]] = []

    def take(self, number: int, own: np.ndarray, low: bool) -> Iterator[tuple[int, int]]:
        """A line is compared with each group until it is linked to it.

        Between two parts only lines of different parts are compared. A line that others link to comes
        to the front of its group, so the original of many variants is compared with first.
        """
        joined, apart = [], []
        for group in self.groups:
            at = next(
                (
                    i
                    for i, (_, other, side) in enumerate(group)
                    if (self.one_part or side != low) and _near(own, other)
                ),
                None,
            )
            if at is None:
                apart.append(group)
                continue
            yield number, group[at][0]
            group[0], group[at] = group[at], group[0]
            joined = joined + group if joined else group
        joined.append((number, own, low))
        self.groups = [*apart, joined]


def _links(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    current, bucket = None, None
    for batch in batches:
        out: list[tuple[int, int]] = []
        columns = (batch[c].tolist() for c in ("bucket", "low", "high", "own", "h1"))
        sets = shingle_sets(batch["line"].tolist(), shingle)
        for name, low, high, own, h1, shingles in zip(*columns, sets):
            if (name, low, high) != current:
                current, bucket = (name, low, high), _Bucket(low == high)
            out.extend(bucket.take(h1, shingles, own == low))
        yield pd.DataFrame(out, columns=["first", "second"], dtype=np.int64)


def near_links(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(first, second): hashes of lines at least 0.8 similar, enough to connect all such lines."""
    bounded_batches(documents)
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = documents.agg(F.coalesce(F.sum(breaks + 1), F.lit(0))).first()[0]
    parts = max(1, -(-n_lines * BANDS // PART_ENTRIES))
    long_lines = _lines(documents).filter(F.length("line") >= shingle).select("h1", "line")
    dealt = long_lines.mapInPandas(
        partial(_dealt, shingle=shingle, parts=parts), "part LONG, entries BINARY"
    )
    by_part = dealt.repartition("part").sortWithinPartitions("part")
    shared = by_part.mapInPandas(_shared, "bucket LONG, h1 LONG")
    members = saved(shared.dropDuplicates(["bucket", "h1"]), "line-buckets")
    # Equal lines become one before the shuffle, so a frequent line is no hot key.
    texts = long_lines.dropDuplicates(["h1"]).join(members.select("h1").distinct(), "h1", "left_semi")
    texts = saved(texts.select("h1", "line", F.length("line").cast("long").alias("chars")), "line-texts")
    cut = F.greatest(
        F.ceil(F.count("*") / BUCKET_LINES), F.ceil(F.sum("chars") / BUCKET_CHARS)
    ).cast("int")
    # Most buckets stay whole; only those that are cut are joined again.
    sizes = members.join(texts.select("h1", "chars"), "h1").groupBy("bucket").agg(cut.alias("parts"))
    sizes = saved(sizes.filter("parts > 1"), "line-bucket-sizes")
    own = F.pmod(F.xxhash64("h1"), F.col("parts")).cast("int").alias("own")
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tasks = (
        members.join(sizes, "bucket", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .select("bucket", "h1", "parts", own)
        .select("bucket", "h1", "own", others)
        .select(
            "bucket",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
            "h1",
        )
    )
    unit = ("bucket", "low", "high")
    with_text = tasks.join(texts.select("h1", "line"), "h1")
    sorted_tasks = with_text.repartition(*unit).sortWithinPartitions(*unit, "own", "h1")
    return sorted_tasks.mapInPandas(partial(_links, shingle=shingle), "first LONG, second LONG")


def dropped_lines(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(_key1, _key2, dropped): per row of ``documents`` the numbers of the lines that go, if any."""
    keys = row_key(documents)
    forest = star_forest(near_links(documents.select("text"), shingle), "first", "second")
    own = F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key1", "_key2", F.col("line_no").alias("line")
    )
    keyed = documents.select("doc_id", "text", *keys)
    lines = saved(
        _lines(keyed, "doc_id", "_key1", "_key2").select(own.alias("place"), "h1", "h2"), "lines"
    )
    linked = forest.unionAll(forest.select("root", "root").distinct())
    counted = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    # A class is a component of near lines, or one text that occurs again; most lines have neither.
    classes = (
        counted.join(linked, F.col("h1") == F.col("node"), "left")
        .filter("n > 1 OR root IS NOT NULL")
        .select(
            "h1",
            "h2",
            F.coalesce("root", "h1").alias("root1"),
            F.when(F.col("root").isNull(), F.col("h2")).otherwise(F.lit(0)).alias("root2"),
        )
    )
    members = saved(
        lines.join(saved(classes, "line-classes"), ["h1", "h2"]).select("root1", "root2", "place"),
        "line-members",
    )
    firsts = members.groupBy("root1", "root2").agg(F.min("place").alias("first"))
    gone = members.join(saved(firsts, "line-firsts"), ["root1", "root2"])
    gone = gone.filter(F.col("place") > F.col("first"))
    return gone.groupBy(
        F.col("place._key1").alias("_key1"), F.col("place._key2").alias("_key2")
    ).agg(F.array_sort(F.collect_set("place.line")).alias("dropped"))


def without_near_lines(documents: DataFrame, into: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents with the remaining lines; one row of each set of equal rows."""
    columns = documents.columns
    keyed = packed(documents, *row_key(documents)).dropDuplicates(["_key1", "_key2"])
    marked = keyed.join(dropped_lines(documents, shingle), ["_key1", "_key2"], "left")
    own = F.col("_row.text")
    kept = F.filter(
        F.transform(F.split(own, "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line"))),
        lambda x: ~F.array_contains("dropped", x["i"]),
    )
    text = F.when(F.col("dropped").isNull(), own).otherwise(
        F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
    )
    others = [F.col(f"_row.`{c}`").alias(c) for c in columns if c != into]
    return marked.select(*others, text.alias(into))


def line_report(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per distinct row ``doc_id``, ``n_lines``, ``n_kept`` and the numbers of dropped lines."""
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    n_lines = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    keyed = (
        documents.select("doc_id", n_lines.alias("n_lines"), *row_key(documents))
        .dropDuplicates(["_key1", "_key2"])
    )
    marked = keyed.join(dropped_lines(documents, shingle), ["_key1", "_key2"], "left")
    none = F.array().cast("array<int>")
    return marked.select(
        "doc_id",
        "n_lines",
        (F.col("n_lines") - F.coalesce(F.size("dropped"), F.lit(0))).alias("n_kept"),
        F.coalesce("dropped", none).alias("dropped"),
    )
