"""Benchmark decontamination: BM25 over an inverted index of test items, searched by every passage.

The test items are indexed; the passages of the training texts are the queries. A posting holds the
item's BM25 impact as a share of the item's score against itself, so one threshold fits all items.
Postings are cut into blocks of consecutive items with the largest impact of each block. As in
block-max WAND, a passage is dropped when the largest impacts of its words cannot reach the threshold,
then each block of items whose block maxima cannot, and only postings in the remaining blocks are
scored. The bounds are never too low, so every item above the threshold is found. The passages of many
texts go through each step together, as numpy arrays.

A passage is two neighbouring stretches of as many words as the longest item has, so an item's copy
always lies inside one. A match is confirmed by the order of its words: the share of the words of the
item's question (all sentences but the last) and answer (the last sentence) that lie in common 5-word
shingles.

The index is built per block of at most ``INDEX_ITEMS`` items, and every block is searched by all
passages; that is the bound on what a task holds. Document frequencies are those of all items.

Words are maximal runs of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z. Null and empty
texts match nothing; items without words are left out; equal items with different ids all match.
Repeated documents each get their matches.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.tables import packed
from tallygrove.llm.text import bounded_batches, runs, whole

K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
INDEX_ITEMS = 20_000
SHINGLE = 5
KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(KEPT).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of all sentences but the last, and of the last; one sentence is both."""
    sentences = [w for w in map(words_of, re.split(r"(?<=[.?!])\s+|\n", text)) if w]
    if len(sentences) < 2:
        both = sentences[0] if sentences else []
        return both, both
    return [w for s in sentences[:-1] for w in s], sentences[-1]


class Index:
    """Postings of some items, as arrays ordered by word and item."""

    def __init__(self, items: list[tuple[int, str]], frequency: Counter, n_items: int, mean: float):
        self.items: list[int] = []
        self.question: list[int] = []  # number of words of the question
        self.one_sentence: list[bool] = []
        self.numbers: dict[bytes, int] = {}
        self.sequences: list[np.ndarray] = []
        words, owners, impacts = [], [], []
        for item_id, text in items:
            question, answer = question_and_answer(text)
            single = question is answer
            every = question if single else question + answer
            if not every:
                continue
            place = len(self.items)
            self.items.append(item_id)
            self.question.append(len(question))
            self.one_sentence.append(single)
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in every]
            self.sequences.append(np.array(ids, np.int64))
            counts = Counter(every)
            raw = []
            for word, count in counts.items():
                df = frequency[word]
                idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
                raw.append(idf * count * (K1 + 1) / (count + K1 * (1 - B + B * len(every) / mean)))
            own = sum(raw)
            words += [self.numbers[w] for w in counts]
            owners += [place] * len(counts)
            impacts += [x / own for x in raw]
        self.n_words, self.n_items = len(self.numbers), len(self.items)
        self.stretch = max((len(s) for s in self.sequences), default=1)
        word, owner = np.array(words, np.int64), np.array(owners, np.int64)
        order = np.lexsort((owner, word))
        word, self.owner = word[order], owner[order]
        self.impact = np.array(impacts)[order]
        block = self.owner // BLOCK_ITEMS
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (block[1:] != block[:-1])
        self.block_first = np.flatnonzero(new)  # first posting of each block of each word
        self.block_size = np.diff(np.append(self.block_first, len(word)))
        self.block = block[self.block_first]
        self.n_blocks = -(-self.n_items // BLOCK_ITEMS)
        self.block_max = (
            np.maximum.reduceat(self.impact, self.block_first) if len(word) else self.impact
        )
        per_word = np.bincount(word[self.block_first], minlength=self.n_words)
        self.word_first = np.cumsum(per_word) - per_word
        self.word_blocks = per_word
        self.word_max = np.zeros(self.n_words)
        np.maximum.at(self.word_max, word, self.impact)


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``first[i] .. first[i] + size[i] - 1`` for all i, and for each place its i."""
    owner = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    return np.arange(len(owner)) - begin[owner] + first[owner], owner


def candidates(index: Index, segments: np.ndarray, words: np.ndarray, joined: np.ndarray, least: float):
    """(passage, item, score) of all pairs with at least ``least``.

    ``words`` are word numbers and ``segments`` the stretch each is in; passage p is stretch p with
    p + 1 where ``joined[p]``.
    """
    n = index.n_words
    own = np.unique(segments * n + words)
    bound = np.bincount(own // n, index.word_max[own % n], len(joined) + 1)
    low = least - 1e-9  # bounds are summed in another order than scores
    live = bound[:-1] + np.where(joined, bound[1:], 0) >= low
    before = own[(own // n > 0)]
    before = before[joined[before // n - 1]] - n
    pairs = np.concatenate([own, before])
    pairs = np.unique(pairs[live[pairs // n]])
    passage, word = pairs // n, pairs % n
    # Blocks of items whose maxima reach the threshold.
    at, entry = _spread(index.word_first[word], index.word_blocks[word])
    live_passages, row = np.unique(passage, return_inverse=True)
    cell = row[entry] * index.n_blocks + index.block[at]
    most = np.bincount(cell, index.block_max[at], len(live_passages) * index.n_blocks)
    opened = most[cell] >= low
    at, row_of, cell = at[opened], row[entry[opened]], cell[opened]
    # Postings in the opened blocks.
    posting, entry = _spread(index.block_first[at], index.block_size[at])
    pair, back = np.unique(row_of[entry] * index.n_items + index.owner[posting], return_inverse=True)
    score = np.bincount(back, index.impact[posting], len(pair))
    found = score >= least
    pair = pair[found]
    return live_passages[pair // index.n_items], pair % index.n_items, score[found]


def overlap(index: Index, item: int, passage: np.ndarray) -> tuple[float, float, int]:
    """Shares of the question's and the answer's words in common shingles, and the first such place."""
    sequence, words = index.sequences[item].tolist(), passage.tolist()
    size = min(SHINGLE, len(sequence))
    places: dict[tuple, int] = {}
    for i in range(len(words) - size, -1, -1):
        places[tuple(words[i : i + size])] = i
    covered, first = [False] * len(sequence), len(words)
    for i in range(len(sequence) - size + 1):
        at = places.get(tuple(sequence[i : i + size]))
        if at is not None:
            covered[i : i + size] = [True] * size
            first = min(first, at)
    cut = index.question[item]
    asked = sum(covered[:cut]) / cut
    if index.one_sentence[item]:
        return asked, asked, first
    return asked, sum(covered[cut:]) / (len(sequence) - cut), first


def matches(
    index: Index, texts: list[str], least: float, question: float, answer: float
) -> list[list[tuple]]:
    """Per text (item_id, score, question overlap, answer overlap, first word) in item order."""
    get, size = index.numbers.get, index.stretch
    sequences = []
    for text in texts:
        words = words_of(text)
        sequences.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)))
    n_segments = np.array([-(-len(s) // size) for s in sequences], np.int64)
    base = np.cumsum(n_segments) - n_segments
    joined = np.ones(int(n_segments.sum()), bool)
    joined[(base + n_segments - 1)[n_segments > 0]] = False
    out: list[dict[int, tuple]] = [{} for _ in texts]
    if not len(joined) or not index.n_items:
        return [[] for _ in texts]
    every = np.concatenate(sequences)
    segments = np.concatenate([b + np.arange(len(s)) // size for b, s in zip(base, sequences)])
    known = every >= 0
    found = candidates(index, segments[known], every[known], joined, least)
    owner = np.repeat(np.arange(len(texts)), n_segments)
    for passage, item, score in zip(*(x.tolist() for x in found)):
        text = int(owner[passage])
        begin = (passage - int(base[text])) * size
        asked, answered, first = overlap(index, item, sequences[text][begin : begin + 2 * size])
        if asked >= question and answered >= answer:
            best = out[text].get(item)
            if best is None or score > best[1]:
                out[text][item] = (index.items[item], score, asked, answered, begin + first)
    return [[found[i] for i in sorted(found)] for found in out]


def indexes(benchmark: DataFrame, index_items: int = INDEX_ITEMS) -> Iterator[Index]:
    """One index per block of items; the items come in blocks, ordered by id, never all at once."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    frequency: Counter = Counter()
    n_items = n_words = 0
    for row in items.toLocalIterator():
        words = words_of(row["text"])
        frequency.update(set(words))
        n_items, n_words = n_items + bool(words), n_words + len(words)
    mean = n_words / max(n_items, 1)
    block: list[tuple[int, str]] = []
    for row in items.orderBy("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) == index_items:
            yield Index(block, frequency, n_items, mean)
            block = []
    if block:
        yield Index(block, frequency, n_items, mean)


KIND = (
    "ARRAY<STRUCT<item_id: LONG, score: DOUBLE, question_overlap: DOUBLE, answer_overlap: DOUBLE, "
    "first_word: LONG>>"
)


def with_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    least: float = 0.5,
    question: float = 0.8,
    answer: float = 0.5,
    into: str = "_matches",
) -> DataFrame:
    """All columns and the array of benchmark items that the text holds; no shuffle."""
    bounded_batches(documents)
    parts = [
        F.pandas_udf(_searcher(index, least, question, answer), KIND).asNondeterministic()("text")
        for index in indexes(benchmark)
    ]
    if not parts:
        return documents.withColumn(into, F.array().cast(KIND))
    return documents.withColumn(into, F.concat(*parts) if len(parts) > 1 else parts[0])


def _searcher(index: Index, least: float, question: float, answer: float):
    names = ("item_id", "score", "question_overlap", "answer_overlap", "first_word")

    def search(texts: pd.Series) -> pd.Series:
        found = []
        for run in runs(whole(texts)):
            found += matches(index, run, least, question, answer)
        return pd.Series([[dict(zip(names, m)) for m in one] for one in found], dtype=object)

    return search


def contaminated(documents: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """One row per document and item that it holds."""
    marked = with_matches(documents.select("doc_id", "text"), benchmark, **limits)
    return marked.select("doc_id", F.inline("_matches"))


def clean(documents: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The documents that hold no item, with their own columns."""
    marked = with_matches(packed(documents, "text"), benchmark, **limits)
    return marked.filter(F.size("_matches") == 0).select("_row.*")
