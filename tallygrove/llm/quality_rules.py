"""Quality rules: counts of a text, and a hashed n-gram logistic regression with a calibrated verdict.

The model sees hashed word unigrams and bigrams and character 3- and 4-grams. Each family's weights
are averaged over the n-grams of the text, so long and short texts are on one scale. It is trained
with numpy on a bounded sample of labelled rows; the executors hash that sample's texts. A part of the
sample that the training does not see sets the calibration (a logistic curve over the raw score).

Edge cases: a null text counts as empty; an empty text has zero counts and fails the base rules. Equal
rows get equal results. Extra columns are carried along. Without labelled rows of both classes the
probability is the share of good labels (1.0 when there are none at all).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.tables import packed
from tallygrove.llm.text import (
    bounded_batches,
    char_grams,
    is_blank,
    labelled_sample,
    mixed,
    points,
    runs,
    span_sums,
    whole,
    words_of,
)

BITS = 17
FAMILIES = 3
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Thresholds:
    """Fixed limits of the verdict.

    ``reject_below`` and ``trust_from`` are probabilities of the label "good"; what lies between them
    is kept as tier "fair".
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    reject_below: float = 0.4
    trust_from: float = 0.8


@dataclass
class QualityModel:
    weights: np.ndarray  # one row per family of n-grams
    bias: float
    slope: float
    offset: float


def _grams(texts: list[str]):
    """Per family the buckets, and per text the spans in them."""
    p = points(texts)
    blank = is_blank(p.codes)
    flat = np.where(blank, np.uint32(32), p.codes)
    w = words_of(p.codes, blank)
    h = w.hashes
    single = mixed((h >> np.uint64(32)).astype(np.uint32), BITS)
    # Two equal words in a row are one feature, whatever the word.
    pair = np.zeros(len(h), np.uint64)
    pair[:-1] = h[:-1] * np.uint64(3) + h[1:]
    pair[:-1][h[:-1] == h[1:]] = 7
    first, last = np.searchsorted(w.begins, p.begins), np.searchsorted(w.begins, p.ends)
    double = mixed((pair >> np.uint64(32)).astype(np.uint32) ^ pair.astype(np.uint32), BITS)
    yield (single, double), first, last, (last, np.maximum(last - 1, first))
    for n in (3, 4):
        yield (char_grams(flat, n, BITS),), p.begins, p.ends, (p.ends,)


def _padded(values: np.ndarray) -> np.ndarray:
    """One more zero, so that spans may reach the end."""
    return np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])


def raw_scores(model: QualityModel, texts: list[str]) -> np.ndarray:
    total = np.full(len(texts), model.bias)
    for family, (buckets, first, _, lasts) in enumerate(_grams(texts)):
        sums, sizes = 0.0, 0
        for own, last in zip(buckets, lasts):
            sums = sums + span_sums(_padded(model.weights[family][own]), first, last)
            sizes = sizes + (last - first)
        total += sums / np.maximum(sizes, 1)
    return total


def probabilities(model: QualityModel, texts: list[str]) -> np.ndarray:
    margin = model.slope * raw_scores(model, texts) + model.offset
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def hashed_row(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text."""
    numbers, values = [], []
    for family, (buckets, first, _, lasts) in enumerate(_grams([text])):
        own = np.concatenate([b[first[0] : last[0]] for b, last in zip(buckets, lasts)])
        if len(own):
            found, counts = np.unique(own, return_counts=True)
            numbers.append(found.astype(np.int64) + (family << BITS))
            values.append(counts / len(own))
    if not numbers:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(numbers).astype(np.int32), np.concatenate(values).astype(np.float32)


def _hashed(batches):
    for batch in batches:
        rows = [hashed_row(t) for t in whole(batch["text"])]
        yield pd.DataFrame(
            {
                "label": batch["label"],
                "numbers": [n.tobytes() for n, _ in rows],
                "values": [v.tobytes() for _, v in rows],
            }
        )


def _rows_of(pdf: pd.DataFrame):
    numbers = [np.frombuffer(x, np.int32) for x in pdf["numbers"]]
    values = [np.frombuffer(x, np.float32) for x in pdf["values"]]
    return numbers, values, pdf["label"].to_numpy(np.float64)


def fit_curve(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over raw scores, by Newton steps with a small ridge."""
    x = np.column_stack([scores, np.ones(len(scores))])
    target = np.where(labels > 0.5, 1 - 0.5 / (labels.sum() + 1), 0.5 / ((1 - labels).sum() + 1))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + 1e-4 * np.eye(2), x.T @ (target - p) - 1e-4 * w
        )
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train_hashed(
    numbers, values, labels, epochs: int = 20, rate: float = 1.0, ridge: float = 1e-6, seed: int = 42
) -> QualityModel:
    """Adaptive mini-batch gradient steps on four fifths; the last fifth sets the calibration."""
    share = labels.mean() if len(labels) else 1.0
    if not 0 < share < 1:
        odds = 40.0 if share else -40.0
        return QualityModel(np.zeros((FAMILIES, 1 << BITS), np.float32), 0.0, 1.0, odds)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    kept_out = order[: len(order) // 5]
    fitted = order[len(order) // 5 :] if len(order) >= 20 else order
    weights = np.zeros(FAMILIES << BITS)
    seen = np.full(FAMILIES << BITS, 1e-8)
    bias, bias_seen = float(np.log(share / (1 - share))), 1e-8
    for _ in range(epochs):
        rng.shuffle(fitted)
        for at in range(0, len(fitted), 64):
            own = fitted[at : at + 64]
            sizes = np.array([len(numbers[i]) for i in own])
            n = np.concatenate([numbers[i] for i in own])
            v = np.concatenate([values[i] for i in own])
            row = np.repeat(np.arange(len(own)), sizes)
            margin = np.bincount(row, weights[n] * v, len(own)) + bias
            error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[own]
            found, back = np.unique(n, return_inverse=True)
            slope = np.bincount(back, error[row] * v) / len(own) + ridge * weights[found]
            seen[found] += slope * slope
            weights[found] -= rate * slope / np.sqrt(seen[found])
            g = error.mean()
            bias_seen += g * g
            bias -= 0.1 * g / np.sqrt(bias_seen)
    model = QualityModel(weights.reshape(FAMILIES, -1).astype(np.float32), bias, 1.0, 0.0)
    judged = kept_out if len(order) >= 20 else order
    raw = np.array([weights[numbers[i]] @ values[i] + bias for i in judged])
    if 0 < labels[judged].sum() < len(judged):
        model.slope, model.offset = fit_curve(raw, labels[judged])
    return model


def train_quality(
    documents: DataFrame, labels: DataFrame, per_class: int = 1500, seed: int = 42
) -> QualityModel:
    """Fit on about ``per_class`` labelled rows of each class (the documented bound)."""
    sample = labelled_sample(
        labels.filter(F.col("quality").isin(0, 1)), "doc_id", "quality", per_class, seed
    )
    # The sample has at most about 2 * per_class short rows, so it may go to every executor.
    chosen = F.broadcast(sample.select("doc_id", F.col("quality").alias("label")))
    texts = documents.select("doc_id", "text").join(chosen, "doc_id").select("label", "text")
    bounded_batches(texts)
    hashed = texts.mapInPandas(_hashed, "label INT, numbers BINARY, values BINARY")
    return train_hashed(*_rows_of(hashed.toPandas()), seed=seed)


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated 3-word windows."""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = 0
    if len(words) > 3:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(numbers) + ids[2:]
        _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[back] > 1
        covered = np.zeros(len(words), bool)
        for i in range(3):
            covered[i : i + len(twice)] |= twice
        repeated = int(covered.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


COLUMNS = (
    "n_words LONG, word_chars LONG, n_symbols LONG, n_dup_lines LONG, n_repeat_words LONG, "
    "probability DOUBLE"
)


def judged(
    documents: DataFrame, model: QualityModel, limits: Thresholds = Thresholds(), into: str = "_quality"
) -> DataFrame:
    """All columns and a struct of counts, probability, ``base_failed``, ``tier`` and ``kept``."""
    bounded_batches(documents)

    def score(texts: pd.Series) -> pd.DataFrame:
        every = whole(texts)
        counts = np.array([text_counts(t) for t in every], np.int64).reshape(-1, 5)
        chances = [probabilities(model, part) for part in runs(every)]
        out = pd.DataFrame(
            counts, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        )
        out["probability"] = np.concatenate(chances) if chances else np.zeros(0)
        return out

    # Marked so that a filter on the verdict does not evaluate it a second time.
    scored = F.pandas_udf(score, COLUMNS).asNondeterministic()(F.col("text"))
    n, chance = F.col(f"{into}.n_words"), F.col(f"{into}.probability")
    failed = (n < limits.min_words) | (
        F.col(f"{into}.n_repeat_words") * 100 > limits.max_repeat_percent * n
    )
    tier = (
        F.when(chance < limits.reject_below, "reject")
        .when(chance < limits.trust_from, "fair")
        .otherwise("good")
    )
    out = documents.withColumn(into, scored)
    return out.withColumn(
        into,
        F.struct(
            f"{into}.*",
            failed.alias("base_failed"),
            tier.alias("tier"),
            (~failed & (tier != "reject")).alias("kept"),
        ),
    )


def kept_documents(
    documents: DataFrame, model: QualityModel, limits: Thresholds = Thresholds()
) -> DataFrame:
    """The documents that pass, with their own columns."""
    marked = judged(packed(documents, "text"), model, limits)
    return marked.filter("_quality.kept").select("_row.*")
