"""Spelling variants: words one edit apart, found by search schemes on bidirectional FM-indexes.

Of two words that differ by one inserted, deleted or replaced code point, one half of the first is intact
in the second. So there are two searches: match the first half exactly and extend over the rest with one
error, or match the second half and extend the other way. A pattern is held as a pair of suffix-rank
intervals: the interval in one direction gives the next symbols, and the counts of smaller symbols keep
the one in the other direction in step, whose rank at the end is the word found. Words are delimited, so a
match is a whole word. All queries of a block advance together in arrays; the symbols that can follow are
read once per interval, however many queries share it.

The vocabulary is dealt out by halves: a word lies where words of its length, or one more or less, that
share its half search for it. So every pair meets, each task indexes a part of the vocabulary, and most
words meet only few others. Groups are put together into indexes of about ``SHARD_WORDS`` words. A half
that more words share is cut into parts by a hash: each part is indexed once, and the queries of that half
go to every part in blocks. What leaves a task is a row per word with the number of its near words and the
best of them, never a pair. Roots follow the forms by pointer doubling; since each form occurs at least
``RATIO`` times as often as its word, chains are short.

Words are counted where the texts are read, so only distinct words are shuffled. They are maximal runs of
A-Z, a-z and U+00C0 to U+00FF in whole texts, with A-Z lower-cased. A null text has no words; a null
``doc_id`` counts as empty in the checksum. Words of any length are handled. Of near words that are equally
frequent, the smallest in code-point order is the form. Repeated rows count each; other columns are not
used. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.tables import saved

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
# Distinct words that a task counts before it passes them on.
COUNTED = 200_000
# Words of one index, and words searched for at a time.
SHARD_WORDS, BLOCK = 50_000, 4_000

# Words are read from Latin-1 bytes, in which every letter of a run is one byte.
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LENGTH)


def _slipped(word: bytes, prefix: int, slips: int) -> bytes:
    """Without one code point, for the words whose checksum ``slips`` divides."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if h % slips:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(batches: Iterable[pa.RecordBatch], slips: int | None) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def ready() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = text.as_py()
            if not own:
                continue
            found = Counter(_RUN.findall(own.encode("latin-1", "replace").lower()))
            prefix = zlib.crc32(f"{doc or ''}:".encode())
            for word, n in found.items():
                kept = word if slips is None else _slipped(word, prefix, slips)
                if len(kept) >= LEAST_LENGTH:
                    counts[kept] += n
            if len(counts) >= COUNTED:
                yield ready()
                counts.clear()
    yield ready()


def word_counts(documents: DataFrame, slips: int | None = None) -> DataFrame:
    """(word, n) of all words of at least ``LEAST_LENGTH`` code points.

    With ``slips``, words whose checksum with the document's id it divides lose a code point first.
    """

    def counted(batches):
        return _count(batches, slips)

    parts = documents.select(F.col("doc_id").cast("string"), "text").mapInArrow(
        counted, "word string, n long"
    )
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class HalfIndex:
    """An FM-index of delimited words, for patterns that begin with a word and grow to its end.

    Symbols are 0 (end of the text), 1 (delimiter) and from 2 on the letters. The transform is that of
    the reversed text, so a pattern grows by one symbol to the right with two rank queries.
    """

    def __init__(self, words: list[str]):
        """``words`` are distinct and in code-point order."""
        text = "\n".join(["", *words, ""])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        breaks = np.zeros(len(codes), bool)
        breaks[np.cumsum([0, *(len(w) + 1 for w in words)])] = True
        self.letters = np.unique(codes[~breaks])
        symbols = np.searchsorted(self.letters, codes) + 2
        symbols[breaks] = 1
        reverse = np.concatenate([symbols[::-1], [0]])
        self.width = len(self.letters) + 3
        order = suffix_order(reverse, self.width)
        self.bwt = reverse[order - 1].astype(np.int32 if self.width > 255 else np.uint8)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(reverse, minlength=self.width))])
        # Counts of each symbol before every block, and the blocks themselves.
        self.shift = max(5, (self.width // 2).bit_length())
        size = 1 << self.shift
        n_blocks = len(reverse) // size + 1
        padded = np.full(n_blocks * size, self.width - 1, self.bwt.dtype)
        padded[: len(reverse)] = self.bwt
        self.blocks = padded.reshape(n_blocks, size)
        cells = np.arange(len(reverse)) // size * self.width + self.bwt
        per_block = np.bincount(cells, minlength=n_blocks * self.width).reshape(n_blocks, self.width)
        self.before = np.zeros((n_blocks, self.width), np.int32)
        np.cumsum(per_block[:-1], axis=0, out=self.before[1:])
        self.n_words = len(words)

    def symbols_of(self, queries: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32)
        if not len(self.letters):
            return np.full(len(codes), self.width - 1)
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[at] == codes, at + 2, self.width - 1)

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place in the transform."""
        block = places >> self.shift
        inside = places & ((1 << self.shift) - 1)
        same = self.blocks[block] == symbols[:, None]
        same &= np.arange(1 << self.shift) < inside[:, None]
        return self.before[block, symbols] + same.sum(axis=1)

    def near(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for all words one error away behind the first ``exact`` code points.

        Each pair is found once: of a run of equal code points only the first is deleted, and a code
        point equal to its neighbour is inserted only behind it.
        """
        sizes = np.fromiter(map(len, queries), np.int64, len(queries))
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.concatenate([self.symbols_of(queries), [self.width - 1]])
        # Error-free patterns: query, interval to grow in, size, interval of words.
        query = np.arange(len(queries))
        low = np.ones(len(queries), np.int64)
        size = np.full(len(queries), self.n_words + 1)
        word = np.ones(len(queries), np.int64)
        open_ = _Patterns.none()
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        depth = 0
        while len(query) or len(open_.query):
            ended = open_.place == sizes[open_.query]
            hits.append(self._ends(open_.take(ended)))
            open_ = self._grown(open_.take(~ended), flat, firsts)
            branching = (exact[query] <= depth) & (depth <= sizes[query])
            states = _Patterns(query, low, size, word, np.full(len(query), depth))
            open_ = _Patterns.all([open_, *self._errors(states.take(branching), flat, firsts, sizes, exact)])
            states = self._grown(states.take(depth < sizes[query]), flat, firsts)
            query, low, size, word = states.query, states.low, states.size, states.word
            depth += 1
        return tuple(np.concatenate(column) for column in zip(*hits))

    def _grown(self, p: _Patterns, flat: np.ndarray, firsts: np.ndarray) -> _Patterns:
        """Each pattern with the query's next code point; those that no word has are left out."""
        symbols = flat[firsts[p.query] + p.place]
        may = (p.size > 1) | (self.bwt[p.low] == symbols)
        p, symbols = p.take(may), symbols[may]
        begin, end = self.rank(symbols, p.low), self.rank(symbols, p.low + p.size)
        kept = end > begin
        # Symbols are grown in the order of the words, so smaller ones come before in their interval.
        several = kept & (p.size > 1)
        skipped = np.zeros(len(begin), np.int64)
        skipped[several] = self._smaller_inside(p.take(several), symbols[several])
        grown = _Patterns(
            p.query, self.smaller[symbols] + begin, end - begin, p.word + skipped, p.place + 1
        )
        return grown.take(kept)

    def _smaller_inside(self, p: _Patterns, symbols: np.ndarray) -> np.ndarray:
        """How many symbols of each interval are smaller, counted once per interval and symbol."""
        pairs, same = np.unique(np.column_stack([p.low, p.size, symbols]), axis=0, return_inverse=True)
        owner, places = _spans(pairs[:, 0], pairs[:, 1])
        less = self.bwt[places] < pairs[owner, 2]
        return np.bincount(owner[less], minlength=len(pairs))[same.ravel()]

    def _ends(self, p: _Patterns) -> tuple[np.ndarray, np.ndarray]:
        """The words that end here: the delimiter is the smallest symbol that can follow."""
        ones = np.ones(len(p.query), np.int64)
        whole = self.rank(ones, p.low + p.size) > self.rank(ones, p.low)
        # Before the words rank the text's end and its last delimiter.
        return p.query[whole], p.word[whole] - 2

    def _errors(self, p, flat, firsts, sizes, exact) -> list[_Patterns]:
        """All patterns with an error at this place."""
        if not len(p.query):
            return []
        own = flat[np.minimum(firsts[p.query] + p.place, len(flat) - 1)]
        inside = p.place < sizes[p.query]
        own = np.where(inside, own, -1)
        previous = flat[firsts[p.query] + np.maximum(p.place - 1, 0)]
        deleted = p.take(inside & ((p.place == exact[p.query]) | (own != previous)))
        deleted = deleted.moved(1)
        # The symbols that follow, once per interval.
        spans, state_span = np.unique(np.column_stack([p.low, p.size]), axis=0, return_inverse=True)
        state_span = state_span.ravel()
        owner, places = _spans(spans[:, 0], spans[:, 1])
        children, counts = np.unique(owner * self.width + self.bwt[places], return_counts=True)
        parent, symbol = children // self.width, children % self.width
        before = np.cumsum(counts) - counts
        first_child = np.searchsorted(parent, np.arange(len(spans)))
        skipped = before - before[first_child[parent]]
        low = self.smaller[symbol] + self.rank(symbol, spans[parent, 0])
        n_children = np.bincount(parent, minlength=len(spans))
        state, child = _spans(first_child[state_span], n_children[state_span])
        kept = (symbol[child] > 1) & (symbol[child] != own[state])
        state, child = state[kept], child[kept]
        grown = _Patterns(
            p.query[state], low[child], counts[child], p.word[state] + skipped[child], p.place[state]
        )
        replaced = grown.take(inside[state]).moved(1)
        return [deleted, replaced, grown]


class _Patterns:
    """Patterns as arrays: query, interval to grow in and its size, first word, code points used."""

    def __init__(self, query, low, size, word, place):
        self.query, self.low, self.size, self.word, self.place = query, low, size, word, place

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.query, self.low, self.size, self.word, self.place

    def take(self, which: np.ndarray) -> _Patterns:
        return _Patterns(*(c[which] for c in self.columns()))

    def moved(self, by: int) -> _Patterns:
        return _Patterns(*self.columns()[:-1], self.place + by)

    @classmethod
    def none(cls) -> _Patterns:
        return cls(*(np.zeros(0, np.int64) for _ in range(5)))

    @classmethod
    def all(cls, parts: list[_Patterns]) -> _Patterns:
        return cls(*(np.concatenate(c) for c in zip(*(p.columns() for p in parts))))


def _spans(firsts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(span, place) for every place of each span."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    return owner, np.arange(len(owner)) - np.repeat(begins - firsts, sizes)


def suffix_order(symbols: np.ndarray, width: int) -> np.ndarray:
    """Suffixes in order, by doubling; the last symbol is unique."""
    n, bits = len(symbols), max(1, (width - 1).bit_length())
    step = max(1, 62 // bits)
    keys = np.zeros(n, np.int64)
    for i in range(step):
        keys <<= bits
        keys[: max(0, n - i)] |= symbols[i:]
    while True:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        ranks = np.zeros(n, np.int64)
        ranks[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if ranks[order[-1]] == n - 1:
            return order
        keys = (ranks + 1) * (n + 2)
        keys[: max(0, n - step)] += ranks[step:] + 1
        step *= 2


def near_best(
    words: list[str], counts: list[int], queries: list[str], backwards: bool
) -> Iterator[tuple[str, int, int, str]]:
    """(query, near words, count of the best, the best) for the queries that have any.

    Forwards the first half of a query is exact; ``backwards`` the second half is, and words whose first
    half is the query's are left to the other search.
    """
    turned = {w[::-1] if backwards else w: (w, n) for w, n in zip(words, counts)}
    ordered = sorted(turned)
    index = HalfIndex(ordered)
    own = [turned[w] for w in ordered]
    for begin in range(0, len(queries), BLOCK):
        block = queries[begin : begin + BLOCK]
        halves = np.fromiter((len(q) // 2 for q in block), np.int64, len(block))
        if backwards:
            lengths = np.fromiter(map(len, block), np.int64, len(block))
            found = index.near([q[::-1] for q in block], lengths - halves)
        else:
            found = index.near(block, halves)
        near: dict[int, tuple[int, int, str]] = {}
        for i, j in zip(*(a.tolist() for a in found)):
            word, n = own[j]
            half = len(block[i]) // 2
            if backwards and word[:half] == block[i][:half]:
                continue
            known = near.get(i)
            if known is None:
                near[i] = (1, n, word)
            elif (n, known[2]) > (known[1], word):
                near[i] = (known[0] + 1, n, word)
            else:
                near[i] = (known[0] + 1, known[1], known[2])
        for i, (size, n, word) in near.items():
            yield block[i], size, n, word


class _Shard:
    """Groups of words put together into one index."""

    def __init__(self, backwards: bool):
        self.backwards = backwards
        self.words: dict[str, int] = {}
        self.queries: dict[str, None] = {}

    def results(self) -> pa.RecordBatch:
        rows = list(
            near_best(list(self.words), list(self.words.values()), list(self.queries), self.backwards)
            if self.words and self.queries
            else ()
        )
        self.queries = {}
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            ["word", "near", "best_n", "best"],
        )


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by group, words to index before words that only search."""
    shard, group = None, None
    names = ("backwards", "half", "part", "parts", "word", "n", "indexed", "asked")
    rows = chain.from_iterable(
        zip(*(batch.column(c).to_pylist() for c in names)) for batch in batches
    )
    for backwards, half, part, parts, word, n, indexed, asked in rows:
        if group != (backwards, half, part):
            alone = parts > 1 or (group is not None and cut)
            if shard and (alone or shard.backwards != backwards or len(shard.words) >= SHARD_WORDS):
                yield shard.results()
                shard = None
            group, cut = (backwards, half, part), parts > 1
            shard = shard or _Shard(backwards)
        if indexed:
            shard.words[word] = n
        if asked:
            shard.queries[word] = None
            # Words that only search come last: the index is complete.
            if not indexed and len(shard.queries) >= SHARD_WORDS:
                yield shard.results()
    if shard:
        yield shard.results()


def _halves(words: DataFrame, shortest: int) -> DataFrame:
    """A row per word and half that words of about its length may share with it."""
    size = F.length("word")

    def half(backwards: bool, length: Column) -> Column:
        own = (size + 1 if backwards else size) / 2
        text = F.right("word", length) if backwards else F.left("word", length)
        return F.struct(
            F.lit(backwards).alias("backwards"),
            F.xxhash64(F.lit(backwards), text).alias("half"),
            (length == F.floor(own).cast("int")).alias("asked"),
        )

    def lengths(backwards: bool) -> Column:
        more = 1 if backwards else 0
        known = [F.floor((size + d + more) / 2).cast("int") for d in (-1, 0, 1)]
        asked = F.lit((shortest + more) // 2)
        return F.filter(F.array_distinct(F.array(*known)), lambda n: n >= asked)

    both = F.concat(
        F.transform(lengths(False), lambda n: half(False, n)),
        F.transform(lengths(True), lambda n: half(True, n)),
    )
    return words.select("word", "n", F.inline(both))


def near_words(words: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """(word, n_near, best_n, best) for all words of (word, n) that have a near one.

    Words are distinct and have at least ``shortest`` code points, two or more.
    """
    n_words = words.count()
    dealt = _halves(words, shortest)
    crowds = dealt.groupBy("half").agg(F.count("*").alias("_size")).filter(F.col("_size") > SHARD_WORDS)
    cut = dealt.join(crowds, "half", "left").withColumn(
        "parts", F.coalesce(F.ceil(F.col("_size") / SHARD_WORDS), F.lit(1)).cast("int")
    )
    own = F.pmod(F.xxhash64(F.lit("part"), "word"), F.col("parts")).cast("int")
    places = F.when(F.col("asked"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    rows = cut.select(
        "backwards", "half", "parts", "word", "n", "asked", own.alias("_own"), F.explode(places).alias("part")
    ).withColumn("indexed", F.col("part") == F.col("_own"))
    ordered = rows.repartition(
        max(1, math.ceil(4 * n_words / SHARD_WORDS)), "backwards", "half", "part"
    ).sortWithinPartitions("backwards", "half", "part", F.desc("indexed"))
    found = ordered.select(
        "backwards", "half", "part", "parts", "word", "n", "indexed", "asked"
    ).mapInArrow(_search, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("_best")
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("_best.less")).alias("best_n"), F.col("_best.best").alias("best"))
    )


def _roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, root) by following (word, form), whose chains have at most ``longest`` steps."""
    roots, steps = forms.select("word", F.col("form").alias("root")), 1
    while steps < longest:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = saved(
            roots.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")),
            "spelling-roots",
        )
        steps *= 2
    return roots


def variants(counts: DataFrame, least: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of (word, n) that occurs ``least`` times.

    Words of fewer than ``LEAST_LENGTH`` code points are left out. ``ratio`` is at least 2.
    """
    if ratio < 2:
        raise ValueError(f"a form must occur at least twice as often as its word, not {ratio} times")
    long_enough = F.length("word") >= LEAST_LENGTH
    words = saved(counts.filter((F.col("n") >= least) & long_enough).select("word", "n"), "vocabulary")
    near = near_words(words)
    often = F.col("best_n") >= F.col("n") * ratio
    linked = saved(
        words.join(near, "word", "left").select(
            "word",
            F.when(often, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(often, F.col("best_n")).alias("form_n"),
        ),
        "spellings",
    )
    most = words.agg(F.max("n")).first()[0] or 1
    steps = math.floor(math.log(max(1, most / max(1, least)), ratio) + 1e-9)
    roots = _roots(linked.filter(F.col("form").isNotNull()).select("word", "form"), steps)
    return linked.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
