"""Token-ID / binary output: all tokens as sequences of one length, in training order, in shards.

The texts' tokens with an end mark after each form one stream, cut into sequences of ``length``; the
last is padded. A keyed Feistel network over the sequence numbers, with cycle-walking down to their
count, gives each sequence its slot in the training order: a one-to-one map that needs no shuffle to
compute and can be inverted. Slots are dealt to tasks by range, and each task writes its shards. A shard
is ``per_shard`` records of ``length`` 16-bit numbers, so slot s is at byte (s mod per_shard) * stride
of shard s div per_shard: a reader can start anywhere.

Tokens are counted per input partition first, so every partition knows where its part of the stream
begins; only those totals reach the driver. The second pass cuts the stream and refuses to go on if a
partition has another total than before. A shard is written under a name of its own and then moved, so
a task that is run again leaves the same files.

Null and empty texts give only the end mark. Repeated rows are repeated. An empty table has no shard.
The table has to come from files, as its partitions are read twice.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from sys import byteorder

import numpy as np
import pandas as pd
import tiktoken
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm.text import bounded_batches, whole

# Fixed value: how the vocabulary's text is cut before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_PATTERN = PATTERN.replace(r"\s+(?!\S)|\s+", r"\s")
WIDE_SPACE = re.compile(r"\s\s").search
# White space as the pattern's \s knows it, in runs that are cut off before the pattern sees them: looking
# ahead, it goes one level deeper for every character of a run.
LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
END = 50_256  # the number after the last rank; ends a text and pads the last sequence
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ROUNDS = 4


class Tokenizer:
    """Token numbers of a text, without the end mark.

    The pattern looks ahead only to split white space of more than one character. A text without any
    is cut by a pattern that does not look ahead, which gives the same pieces in two thirds of the time.
    Of a long run of white space all but the last character are a piece of their own, as the pattern has
    it; at the end of the text the whole run is.
    """

    def __init__(self, ranks_file: bytes):
        pairs = (line.split() for line in ranks_file.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}

        def encoding(pattern: str):
            return tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary

        self.any_text, self.plain_text = encoding(PATTERN), encoding(PLAIN_PATTERN)
        self.piece = encoding(r"[\s\S]+")

    def encode(self, text: str) -> list[int]:
        if not WIDE_SPACE(text):
            return self.plain_text(text)
        out, at = [], 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.any_text(text[at : run.start()])
            out += self.piece(text[run.start() : end])
            at = end
        return out + self.any_text(text[at:])


def _packed(numbers: list[int]) -> bytes:
    packed = array("H", numbers)
    if byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@lru_cache(maxsize=1)
def tokenizer(ranks_file: bytes) -> Tokenizer:
    return Tokenizer(ranks_file)


@dataclass(frozen=True)
class Permutation:
    """A keyed one-to-one map of 0 .. count - 1 onto itself."""

    count: int
    key: int = 42

    @property
    def half(self) -> int:
        return max(1, (max(self.count - 1, 1).bit_length() + 1) // 2)

    def _mix(self, x: np.ndarray, turn: int) -> np.ndarray:
        salt = (self.key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & (2**64 - 1)
        h = (x + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
        return h & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        bits, low = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> bits, x & low
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._mix(left, turn), left
            else:
                left, right = right, left ^ self._mix(right, turn)
        return (left << bits) | right

    def _walk(self, numbers, back: bool) -> np.ndarray:
        """Apply the network until the result is below the count; it must come back there."""
        x = self._once(np.asarray(numbers, np.uint64), back)
        while (outside := x >= self.count).any():
            x[outside] = self._once(x[outside], back)
        return x.astype(np.int64)

    def slots(self, sequences) -> np.ndarray:
        return self._walk(sequences, False)

    def sequences(self, slots) -> np.ndarray:
        return self._walk(slots, True)


def _stream(batches: Iterator[pd.DataFrame], ranks_file: bytes) -> Iterator[list[int]]:
    """The tokens of each text."""
    encode = tokenizer(ranks_file).encode
    for batch in batches:
        for text in whole(batch["text"]):
            yield encode(text)


def _counter(ranks_file: bytes):
    def count(batches):
        total = sum(len(x) + 1 for x in _stream(batches, ranks_file))
        if total:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "tokens": [total]})

    return count


def _cutter(ranks_file: bytes, begins: dict[int, int], sizes: dict[int, int], length: int, order: Permutation):
    """Pieces of sequences: slot, place within the sequence and bytes.

    Only a partition's first and last sequence can be shared with another partition.
    """

    def cut(batches):
        part = TaskContext.get().partitionId()
        at, held, seen = begins.get(part, 0), bytearray(), 0
        out: list[tuple[int, int, bytes]] = []

        def frame():
            pdf = pd.DataFrame(out, columns=["sequence", "place", "piece"])
            pdf["slot"] = order.slots(pdf["sequence"].to_numpy(np.uint64))
            out.clear()
            return pdf[["slot", "place", "piece"]]

        for encoded in _stream(batches, ranks_file):
            encoded.append(END)
            held += _packed(encoded)
            seen += len(encoded)
            begin = 0
            while (room := 2 * (length - at % length)) <= len(held) - begin:
                out.append((at // length, at % length, bytes(held[begin : begin + room])))
                begin += room
                at += room // 2
            del held[:begin]
            if len(out) >= 512:
                yield frame()
        if held:
            out.append((at // length, at % length, bytes(held)))
        if seen != sizes.get(part, 0):
            raise RuntimeError(f"partition {part} changed between two reads of the table")
        if out:
            yield frame()

    return cut


def _put(path: str, name: str, content: bytes) -> None:
    store, root = fs.FileSystem.from_uri(path)
    attempt = TaskContext.get().taskAttemptId()
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/_{name}.{attempt}") as out:
        out.write(content)
    store.move(f"{root}/_{name}.{attempt}", f"{root}/{name}")


def _writer(path: str, length: int, per_shard: int, count: int):
    """Write whole shards from pieces sorted by slot and place; one row per shard."""
    stride = 2 * length
    padding = np.array([END], "<u2").tobytes()

    def write(batches):
        shard, content = None, bytearray()

        def close():
            records = min(per_shard, count - shard * per_shard)
            if len(content) < records * stride:  # only the very last sequence is short
                content.extend(padding * ((records * stride - len(content)) // 2))
            _put(path, f"shard-{shard:09d}.bin", bytes(content))
            return pd.DataFrame(
                {"shard": [shard], "sequences": [records], "bytes": [len(content)],
                 "checksum": [zlib.crc32(content)]}
            )

        for batch in batches:
            for slot, place, piece in zip(batch["slot"], batch["place"], batch["piece"]):
                if slot // per_shard != shard:
                    if shard is not None:
                        yield close()
                    shard, content = slot // per_shard, bytearray()
                want = (slot % per_shard) * stride + 2 * place
                if len(content) < want:  # after the stream's last, short sequence
                    content.extend(padding * ((want - len(content)) // 2))
                if len(content) != want:
                    raise RuntimeError(f"slot {slot} has a piece twice")
                content += piece
        if shard is not None:
            yield close()

    return write


@dataclass
class Shards:
    """What was written: a row per shard, and how to read it."""

    manifest: DataFrame
    path: str
    order: Permutation
    length: int
    per_shard: int
    n_tokens: int


def write_shards(
    documents: DataFrame,
    path: str,
    length: int = 1024,
    per_shard: int = 1024,
    key: int = 42,
    vocabulary: str = VOCABULARY,
) -> Shards:
    """Tokenise ``text`` and write the shards below ``path``, a folder that all executors share."""
    spark: SparkSession = documents.sparkSession
    bounded_batches(documents)
    with open(vocabulary, "rb") as file:
        ranks_file = file.read()
    texts = documents.select("text")
    counted = texts.mapInPandas(_counter(ranks_file), "part INT, tokens LONG").collect()
    sizes = {row["part"]: row["tokens"] for row in counted}
    begins, total = {}, 0
    for part in sorted(sizes):
        begins[part] = total
        total += sizes[part]
    count = -(-total // length)
    order = Permutation(count, key)
    pieces = texts.mapInPandas(
        _cutter(ranks_file, begins, sizes, length, order), "slot LONG, place INT, piece BINARY"
    )
    n_shards = -(-count // per_shard)
    # Ranges of slots are known beforehand, so nothing needs to be sampled.
    n_tasks = max(1, min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    per_task = -(-max(n_shards, 1) // n_tasks)
    task = F.expr(f"cast(slot div {per_shard} div {per_task} as int)")
    dealt = pieces.repartitionById(n_tasks, task).sortWithinPartitions("slot", "place")
    manifest = dealt.mapInPandas(
        _writer(path, length, per_shard, count),
        "shard LONG, sequences LONG, bytes LONG, checksum LONG",
    )
    rows = manifest.collect() if count else []
    kind = "shard LONG, sequences LONG, bytes LONG, checksum LONG"
    return Shards(spark.createDataFrame(rows, kind), path, order, length, per_shard, total)


def read_shards(spark: SparkSession, shards: Shards, from_slot: int = 0) -> DataFrame:
    """One row per sequence from ``from_slot`` on: ``slot``, ``shard``, ``place``, ``sequence``, ``tokens``.

    ``place`` is the byte at which the record begins and ``sequence`` its number in the stream.
    """
    stride, per_shard, order = 2 * shards.length, shards.per_shard, shards.order

    def records(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                shard = int(path.rpartition("-")[2].removesuffix(".bin"))
                first = max(0, from_slot - shard * per_shard)
                places = np.arange(first, len(content) // stride)
                if len(places):
                    slots = shard * per_shard + places
                    yield pd.DataFrame(
                        {
                            "slot": slots,
                            "shard": shard,
                            "place": places * stride,
                            "sequence": order.sequences(slots),
                            "tokens": [bytes(content[p * stride : (p + 1) * stride]) for p in places],
                        }
                    )

    kind = "slot LONG, shard LONG, place LONG, sequence LONG, tokens BINARY"
    if not order.count:
        return spark.createDataFrame([], kind)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(shards.path)
    least = from_slot // per_shard
    number = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long")
    return files.filter(number >= least).select("path", "content").mapInPandas(records, kind)
