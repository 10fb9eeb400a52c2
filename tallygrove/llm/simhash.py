"""SimHash near-duplicates: 64-bit fingerprints, linked at two or fewer differing bits by BK-trees.

A fingerprint bit is the majority over the XXH64 hashes of a text's 3-word shingles. Equal
fingerprints are brought together first, so each distinct one is a single row. Two that differ in at
most two bits agree in at least two of four 16-bit blocks; hence each fingerprint goes to the six
shards named by a pair of its blocks, and every link lies inside a shard. A shard's BK-tree is built
in the task that holds the shard, since no tree over all fingerprints has a bound that would allow to
broadcast it. A search follows only the children whose distance to their parent lies within the
radius of the query's. Shards beyond ``SHARD_ROWS`` are cut into parts, and each pair of parts is a
task of its own, so no task grows with a hot shard. A task reports a spanning forest of its links,
never all pairs; the components come from ``components``.

Edge cases: null and empty texts have fingerprint zero, which links like any other. Rows may repeat.
A null ``doc_id`` takes part in linking and is passed over when the smallest id is sought; a component
of nulls alone has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.components import star_forest
from tallygrove.llm.tables import packed, row_key, saved
from tallygrove.llm.text import bounded_batches

SEED = 42
RADIUS = 2
BLOCK_BITS = 16
SHARD_ROWS = 2_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    shingles = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
    n = max(1, len(words) - 2)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(s), SEED) for s in shingles), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(documents: DataFrame, into: str = "_fingerprint") -> DataFrame:
    bounded_batches(documents)

    def every(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype=np.int64)

    return documents.withColumn(into, F.pandas_udf(every, "LONG").asNondeterministic()("text"))


class BKTree:
    """Numbers by Hamming distance; a child's key is its distance to its parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the values at most ``radius`` bits away."""
        values, children = self.values, self.children
        found, open_ = [], [0] if values else []
        while open_:
            at = open_.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            own = children[at]
            for edge in range(max(1, distance - radius), distance + radius + 1):
                if edge in own:
                    open_.append(own[edge])
        return found

    def add(self, value: int) -> int:
        values, children = self.values, self.children
        values.append(value)
        children.append({})
        place = len(values) - 1
        at = 0
        while at != place:
            distance = (values[at] ^ value).bit_count()
            at = children[at].setdefault(distance, place)
        return place


class _Shard:
    """Links within one shard, or between two parts of a large one, as a spanning forest."""

    def __init__(self, one_part: bool) -> None:
        self.tree, self.one_part = BKTree(), one_part
        self.above: list[int] = []
        self.values: list[int] = []

    def _root(self, at: int) -> int:
        above = self.above
        while above[at] != at:
            above[at] = above[above[at]]
            at = above[at]
        return at

    def take(self, value: int, to_tree: bool) -> Iterator[tuple[int, int]]:
        """Links that ``value`` adds. Members of the tree come before those that only search it."""
        unsigned = value & 0xFFFFFFFFFFFFFFFF
        searches = self.one_part or not to_tree
        near = self.tree.within(unsigned, RADIUS) if searches else []
        place = len(self.above)
        self.above.append(place)
        self.values.append(value)
        for other in near:
            a, b = self._root(place), self._root(other)
            if a != b:
                self.above[a] = b
                yield value, self.values[other]
        if to_tree:
            self.tree.add(unsigned)


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by shard and part; a shard may go on in the next batch."""
    current, shard = None, None
    for batch in batches:
        out: list[tuple[int, int]] = []
        columns = (batch[c].to_numpy().tolist() for c in ("pair", "key", "low", "high", "own", "value"))
        for pair, key, low, high, own, value in zip(*columns):
            if (pair, key, low, high) != current:
                current, shard = (pair, key, low, high), _Shard(low == high)
            out.extend(shard.take(value, own == low))
        yield pd.DataFrame(out, columns=["first", "second"], dtype=np.int64)


def near_links(fingerprints: DataFrame, value: str = "fingerprint") -> DataFrame:
    """(first, second): links that connect all distinct fingerprints at most two bits apart."""
    blocks = [((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * i) for i in range(64 // BLOCK_BITS)]
    masks = [sum(chosen) for chosen in combinations(blocks, len(blocks) - RADIUS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    own = F.col(value)
    pieces = fingerprints.select(
        own.alias("value"),
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(i).alias("pair"), own.bitwiseAND(F.lit(m)).alias("key"))
                    for i, m in enumerate(signed)
                )
            )
        ),
    )
    shards = pieces.groupBy("pair", "key").count().filter("count > 1")
    shards = saved(
        shards.select("pair", "key", F.ceil(F.col("count") / SHARD_ROWS).cast("int").alias("parts")),
        "simhash-shards",
    )
    members = pieces.join(shards, ["pair", "key"]).withColumn(
        "own", F.pmod(F.xxhash64("value"), F.col("parts")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tasks = members.select("pair", "key", "value", "own", others).select(
        "pair",
        "key",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "value",
    )
    unit = ("pair", "key", "low", "high")
    sorted_tasks = tasks.repartition(*unit).sortWithinPartitions(*unit, "own", "value")
    return sorted_tasks.mapInPandas(_links, "first LONG, second LONG")


def component_ids(marked: DataFrame) -> DataFrame:
    """(fingerprint, root, component_id) from rows with ``doc_id`` and ``_fingerprint``.

    ``root`` names the component also where all its ids are null.
    """
    distinct = saved(
        marked.groupBy(F.col("_fingerprint").alias("fingerprint")).agg(
            F.min("doc_id").alias("lowest")
        ),
        "simhash-distinct",
    )
    forest = star_forest(near_links(distinct), "first", "second")
    rooted = distinct.join(forest, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "lowest", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    # A table of its own, so that Spark can split a fingerprint that very many rows share.
    return saved(
        rooted.join(ids, "root").select("fingerprint", "root", "component_id"), "simhash-ids"
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id``."""
    marked = saved(
        with_fingerprint(documents.select("doc_id", "text")).drop("text"), "simhash-marked"
    )
    found = marked.join(
        component_ids(marked), F.col("_fingerprint") == F.col("fingerprint")
    )
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("_fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` but one per component: that with the smallest ``doc_id``.

    Among rows with that id, a hash of the row decides; of fully equal rows one stays.
    """
    keys = row_key(documents)
    marked = saved(
        with_fingerprint(documents.select("doc_id", "text", *keys)).drop("text"), "simhash-marked"
    )
    found = marked.join(component_ids(marked), F.col("_fingerprint") == F.col("fingerprint"))
    # Null ids come last within a component.
    kept = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key1", "_key2")).alias("least"))
        .select("least._key1", "least._key2")
    )
    stays = packed(documents, *keys).join(kept, ["_key1", "_key2"], "left_semi")
    return stays.dropDuplicates(["_key1", "_key2"]).select("_row.*")
