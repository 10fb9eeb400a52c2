"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is good or bad. Its features are shares of symbols, capitals, digits and repeated words and
the like, of the line itself and of the lines before and after it. Document labels stand in for line
labels: all lines of a document start with its label, then lines of bad documents that the first fit
finds clearly good are relabelled and the chain is fitted again. A document's quality is the mean
probability of "good" over its lines, weighted by their length; a logistic curve over it, set on rows
the fit did not see, gives the score.

Edge cases: null and empty texts have one line without characters, which is scored like any line.
Without labelled rows of both classes the score is the share of good labels (1.0 if there are none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.quality_rules import fit_curve
from tallygrove.llm.text import (
    bounded_batches,
    is_blank,
    labelled_sample,
    letters,
    points,
    runs,
    span_sums,
    whole,
    words_of,
)

OWN = 16
N_FEATURES = 3 * OWN


@dataclass
class Lines:
    """Features and characters of each line; document ``i`` has ``counts[i]`` lines in a row."""

    features: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray


@dataclass
class ChainModel:
    weights: np.ndarray  # of "good" against "bad"
    steps: np.ndarray  # 2 x 2, from the state of a line to that of the next
    slope: float
    offset: float


def _share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
    return part / np.maximum(of, 1)


def lines_of(texts: list[str]) -> Lines:
    p = points(texts)
    codes = p.codes
    breaks = np.flatnonzero(codes == 10)
    ends = np.sort(np.concatenate([breaks, p.ends]))
    begins = np.sort(np.concatenate([breaks + 1, p.begins]))
    counts = np.searchsorted(begins, p.ends, "right") - np.searchsorted(begins, p.begins)
    blank = is_blank(codes)
    letter = letters()[codes]
    digit = (codes >= 48) & (codes <= 57)
    upper = ((codes >= 65) & (codes <= 90)) | ((codes >= 0xC0) & (codes <= 0xDE))
    stops = np.isin(codes, np.frombuffer(".,;:'\"()?-".encode("utf-32-le"), np.uint32))
    loud = codes == 33
    symbol = ~(blank | letter | digit | stops | loud)
    marks = np.column_stack([letter, digit, upper, stops, loud, symbol, blank]).astype(np.int32)
    n_letter, n_digit, n_upper, n_stops, n_loud, n_symbol, n_blank = span_sums(
        marks, begins, ends
    ).T
    size = ends - begins
    solid = size - n_blank
    w = words_of(codes, blank)
    first, last = np.searchsorted(w.begins, begins), np.searchsorted(w.begins, ends)
    n_words = last - first
    line = np.repeat(np.arange(len(begins)), n_words)
    again = np.zeros(len(w.hashes) + 1, np.int64)
    bare = np.zeros(len(w.hashes) + 1, np.int64)
    if len(w.hashes):
        same = (w.hashes[1:] == w.hashes[:-1]) & (line[1:] == line[:-1])
        again[1 : len(w.hashes)] = same
        bare[: len(w.hashes)] = ~np.logical_or.reduceat(letter, w.begins) if len(w.begins) else 0
    n_again, n_bare = span_sums(again, first, last), span_sums(bare, first, last)
    order = np.lexsort((w.hashes, line))
    fresh = np.ones(len(order), np.int64)
    if len(order):
        a, b = order[1:], order[:-1]
        fresh[1:] = (w.hashes[a] != w.hashes[b]) | (line[a] != line[b])
    n_distinct = np.bincount(line[order], fresh, len(begins)) if len(order) else n_words * 0
    # A line's hash: the sum of its words' hashes, turned by their place in the line.
    turn = (np.arange(len(w.hashes)) - np.repeat(first, n_words)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    held = np.zeros(len(w.hashes) + 1, np.uint64)
    held[: len(w.hashes)] = w.hashes * turn
    whole_line = span_sums(held, first, last)
    doc = np.repeat(np.arange(len(texts)), counts)
    by = np.lexsort((np.arange(len(doc)), whole_line, doc))
    seen = np.zeros(len(doc), bool)
    a, b = by[1:], by[:-1]
    seen[a] = (whole_line[a] == whole_line[b]) & (doc[a] == doc[b]) & (n_words[a] > 0)
    ended = np.zeros(len(begins), bool)
    filled = size > 0
    ended[filled] = np.isin(codes[ends[filled] - 1], (46, 63, 33, 58))
    own = np.column_stack(
        [
            np.ones(len(begins)),
            _share(n_symbol, solid),
            _share(n_upper, n_letter),
            _share(n_digit, solid),
            _share(n_stops + n_loud, solid),
            _share(n_loud, n_words),
            _share(n_again, n_words),
            _share(n_bare, n_words),
            _share(n_distinct, n_words),
            np.log1p(size) / 10,
            np.minimum(_share(solid, n_words), 30) / 10,
            seen,
            ended,
            _share(n_symbol, solid) > 0.05,
            _share(n_upper, n_letter) > 0.5,
            _share(n_again, n_words) > 0.3,
        ]
    ).astype(np.float32)
    same_doc = np.zeros(len(begins) + 1, bool)
    same_doc[1:-1] = doc[1:] == doc[:-1]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[~same_doc[:-1]] = 0
    after[:-1] = own[1:]
    after[~same_doc[1:]] = 0
    return Lines(np.hstack([own, before, after]), size, counts)


def _lse(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(
    margins: np.ndarray, counts: np.ndarray, steps: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Probability of "good" per line, and per line that of each step into it (4 columns).

    The documents advance together, line by line; those that are through drop out.
    """
    starts = np.cumsum(counts) - counts
    longest_first = np.argsort(-counts, kind="stable")
    begin, size = starts[longest_first], counts[longest_first]
    n = len(margins)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    longest = int(size[0]) if len(size) else 0
    through = np.searchsorted(-size, -np.arange(longest), "left")  # documents with more lines than t
    for t in range(longest):
        at = begin[: through[t]] + t
        if t:
            was = ahead[at - 1]
            ahead[at, 0] = _lse(was[:, 0] + steps[0, 0], was[:, 1] + steps[1, 0])
            ahead[at, 1] = _lse(was[:, 0] + steps[0, 1], was[:, 1] + steps[1, 1])
        ahead[at, 1] += margins[at]
    for t in range(longest - 2, -1, -1):
        at = begin[: through[t + 1]] + t
        then = back[at + 1] + np.column_stack([np.zeros(len(at)), margins[at + 1]])
        back[at, 0] = _lse(steps[0, 0] + then[:, 0], steps[0, 1] + then[:, 1])
        back[at, 1] = _lse(steps[1, 0] + then[:, 0], steps[1, 1] + then[:, 1])
    joint = ahead + back
    total = _lse(joint[:, 0], joint[:, 1])
    good = np.exp(joint[:, 1] - total)
    into = np.zeros((n, 4))
    if n:
        inner = np.ones(n, bool)
        inner[starts[counts > 0]] = False
        at = np.flatnonzero(inner)
        own = np.column_stack([np.zeros(len(at)), margins[at]])
        for i in (0, 1):
            for j in (0, 1):
                into[at, 2 * i + j] = np.exp(
                    ahead[at - 1, i] + steps[i, j] + own[:, j] + back[at, j] - total[at]
                )
    return good, into


def _fit(lines: Lines, states: np.ndarray, rounds: int, ridge: float = 1e-4):
    """Gradient ascent on the likelihood with Adam steps; each document weighs the same."""
    weights, steps = np.zeros(N_FEATURES), np.zeros((2, 2))
    starts = np.cumsum(lines.counts) - lines.counts
    share = np.repeat(1 / np.maximum(lines.counts, 1), lines.counts) / len(lines.counts)
    inner = np.ones(len(states), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    observed = np.zeros((len(states), 4))
    observed[at, 2 * states[at - 1] + states[at]] = 1
    first, second = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for t in range(1, rounds + 1):
        good, into = marginals(lines.features @ weights, lines.counts, steps)
        slope = np.concatenate(
            [
                lines.features.T @ (share * (states - good)) - ridge * weights,
                share @ (observed - into) - ridge * steps.ravel(),
            ]
        )
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        move = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        weights += move[:N_FEATURES]
        steps += move[N_FEATURES:].reshape(2, 2)
    return weights, steps


def _pick(lines: Lines, docs: np.ndarray) -> tuple[Lines, np.ndarray]:
    starts = np.cumsum(lines.counts) - lines.counts
    rows = (
        np.concatenate([np.arange(starts[d], starts[d] + lines.counts[d]) for d in docs])
        if len(docs)
        else np.zeros(0, np.int64)
    )
    return Lines(lines.features[rows], lines.sizes[rows], lines.counts[docs]), rows


def qualities(lines: Lines, weights: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Length-weighted mean probability of "good" per document, as log-odds."""
    good, _ = marginals(lines.features @ weights, lines.counts, steps)
    starts = np.cumsum(lines.counts) - lines.counts
    heavy = lines.sizes + 1.0
    mean = np.add.reduceat(good * heavy, starts) / np.add.reduceat(heavy, starts)
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def train_chain(
    lines: Lines, labels: np.ndarray, rounds: int = 120, clear: float = 0.9, seed: int = 42
) -> ChainModel:
    share = labels.mean() if len(labels) else 1.0
    if not 0 < share < 1:
        return ChainModel(np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0, 40.0 if share else -40.0)
    order = np.random.default_rng(seed).permutation(len(labels))
    cut = len(order) // 4 if len(order) >= 20 else 0
    fitted, judged = order[cut:], order[:cut] if cut else order
    part, _ = _pick(lines, fitted)
    target = np.repeat(labels[fitted], part.counts).astype(np.int64)
    weights, steps = _fit(part, target, rounds)
    good, _ = marginals(part.features @ weights, part.counts, steps)
    relabelled = np.where(target == 1, 1, (good > clear).astype(np.int64))
    starts = np.cumsum(part.counts) - part.counts
    worst_bad = np.minimum.reduceat(relabelled, starts)
    all_good = np.repeat((worst_bad == 1) & (labels[fitted] == 0), part.counts)
    weights, steps = _fit(part, np.where(all_good, target, relabelled), rounds)
    seen, _ = _pick(lines, judged)
    slope, offset = fit_curve(qualities(seen, weights, steps), labels[judged])
    return ChainModel(weights, steps, slope, offset)


def _featured(batches):
    for batch in batches:
        out = []
        for part in runs(whole(batch["text"])):
            found = lines_of(part)
            starts = np.cumsum(found.counts) - found.counts
            out += [
                (found.features[s : s + c].tobytes(), found.sizes[s : s + c].tobytes())
                for s, c in zip(starts, found.counts)
            ]
        yield pd.DataFrame(
            {
                "label": batch["label"],
                "features": [f for f, _ in out],
                "sizes": [s for _, s in out],
            }
        )


def fit_line_chain(
    documents: DataFrame, labels: DataFrame, per_class: int = 800, seed: int = 42
) -> ChainModel:
    """Fit on about ``per_class`` labelled rows of each class (the documented bound), whole texts."""
    sample = labelled_sample(
        labels.filter(F.col("quality").isin(0, 1)), "doc_id", "quality", per_class, seed
    )
    # At most about 2 * per_class short rows.
    chosen = F.broadcast(sample.select("doc_id", F.col("quality").alias("label")))
    texts = documents.select("doc_id", "text").join(chosen, "doc_id").select("label", "text")
    bounded_batches(texts)
    rows = texts.mapInPandas(_featured, "label INT, features BINARY, sizes BINARY").toPandas()
    features = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for x in rows["features"]]
    sizes = [np.frombuffer(x, np.int64) for x in rows["sizes"]]
    counts = np.array([len(s) for s in sizes], np.int64)
    joined = Lines(
        np.concatenate(features) if features else np.zeros((0, N_FEATURES), np.float32),
        np.concatenate(sizes) if sizes else np.zeros(0, np.int64),
        counts,
    )
    return train_chain(joined, rows["label"].to_numpy(np.int64), seed=seed)


def document_scores(model: ChainModel, texts: list[str]) -> np.ndarray:
    margin = model.slope * qualities(lines_of(texts), model.weights, model.steps) + model.offset
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def scored(documents: DataFrame, model: ChainModel, into: str = "_score") -> DataFrame:
    """All columns and the document's score between 0 and 1."""
    bounded_batches(documents)

    def score(texts: pd.Series) -> pd.Series:
        found = [document_scores(model, part) for part in runs(whole(texts))]
        return pd.Series(np.concatenate(found) if found else np.zeros(0))

    return documents.withColumn(into, F.pandas_udf(score, "DOUBLE").asNondeterministic()("text"))


LINES = "ARRAY<STRUCT<line_no: INT, probability: DOUBLE, label: INT>>"


def line_labels(documents: DataFrame, model: ChainModel, into: str = "_lines") -> DataFrame:
    """All columns and, per line of the text, its number, the probability of "good" and the label 0 or 1.

    The probabilities are the marginals of which ``scored`` takes the length-weighted mean. A model of
    one class only gives 0.5 for each line.
    """
    bounded_batches(documents)

    def label(texts: pd.Series) -> pd.Series:
        out: list[list[dict]] = []
        for part in runs(whole(texts)):
            lines = lines_of(part)
            good, _ = marginals(lines.features @ model.weights, lines.counts, model.steps)
            for own in np.split(good, np.cumsum(lines.counts)[:-1]):
                out.append(
                    [{"line_no": i, "probability": p, "label": int(p >= 0.5)} for i, p in enumerate(own.tolist())]
                )
        return pd.Series(out, dtype=object)

    return documents.withColumn(into, F.pandas_udf(label, LINES).asNondeterministic()("text"))
