"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased, everything but letters becomes a blank, and its words and character n-grams
(2 to 4, blanks included) are hashed. Their embeddings are averaged and a linear layer gives one score
per language. Both are trained together by stochastic gradient descent in numpy on a bounded sample.
A part of the sample that the training does not see sets the temperature of the softmax and the
rejection threshold: the lowest probability at which the accepted texts reach the wanted precision.

Edge cases: a text that is null or has no letter is ``und`` with score 0 and is not accepted. Without
any labelled row every text is ``und``. Ties between languages go to the first in alphabetical order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.text import (
    bounded_batches,
    char_grams,
    labelled_sample,
    letters,
    mixed,
    points,
    runs,
    span_sums,
    words_of,
)

BITS = 15
GRAMS = (2, 3, 4)
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # scores per bucket and language: embeddings times the linear layer
    bias: np.ndarray
    temperature: float
    accept_from: float


def _subwords(texts: list[str]):
    """(buckets, first, last) for words and n-grams, and the number of letters per text."""
    p = points([t.lower() for t in texts])
    letter = letters()[p.codes]
    n_letters = span_sums(letter.astype(np.int64), p.begins, p.ends)
    # Blanks in a row become one.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[p.begins] = True
    codes = np.where(letter, p.codes, np.uint32(32))[kept]
    upto = np.concatenate([[0], np.cumsum(kept)])
    begins, ends = upto[p.begins], upto[p.ends]
    codes = np.concatenate([codes, np.full(8, 32, np.uint32)])
    w = words_of(codes, codes == 32)
    words = mixed((w.hashes >> np.uint64(32)).astype(np.uint32), BITS)
    found = [(words, np.searchsorted(w.begins, begins), np.searchsorted(w.begins, ends))]
    for n in GRAMS:
        found.append((char_grams(codes, n, BITS), begins, ends))
    return found, n_letters


def _hashed(batches):
    for batch in batches:
        numbers, values = [], []
        for text in batch["text"]:
            found, _ = _subwords([text])
            own = np.concatenate([b[f[0] : e[0]] for b, f, e in found])
            n, c = np.unique(own, return_counts=True)
            numbers.append(n.astype(np.int32).tobytes())
            values.append((c / max(len(own), 1)).astype(np.float32).tobytes())
        yield pd.DataFrame({"label": batch["label"], "numbers": numbers, "values": values})


def train_embeddings(
    numbers,
    values,
    labels: list[str],
    width: int = 12,
    epochs: int = 8,
    rate: float = 0.3,
    precision: float = 0.99,
    seed: int = 42,
) -> LanguageModel:
    languages = sorted(set(labels))
    k = len(languages)
    if not k:
        return LanguageModel([], np.zeros((1 << BITS, 1), np.float32), np.zeros(1), 1.0, 1.0)
    place = {x: i for i, x in enumerate(languages)}
    target = np.array([place[x] for x in labels])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(target))
    cut = len(order) // 5 if len(order) >= 20 else 0
    fitted, judged = order[cut:].copy(), order[:cut] if cut else order
    table = rng.normal(0, 0.1, (1 << BITS, width))
    layer, bias = rng.normal(0, 0.1, (width, k)), np.zeros(k)
    seen_table, seen_layer = np.full(1 << BITS, 1e-6), np.full((width, k), 1e-6)

    def forward(own):
        sizes = np.array([len(numbers[i]) for i in own])
        n = np.concatenate([numbers[i] for i in own])
        v = np.concatenate([values[i] for i in own])
        row = np.repeat(np.arange(len(own)), sizes)
        first = np.cumsum(sizes) - sizes
        hidden = span_sums(
            np.concatenate([table[n] * v[:, None], np.zeros((1, width))]), first, first + sizes
        )
        return n, v, row, hidden, hidden @ layer + bias

    for _ in range(epochs):
        rng.shuffle(fitted)
        for at in range(0, len(fitted), 32):
            own = fitted[at : at + 32]
            n, v, row, hidden, out = forward(own)
            chance = np.exp(out - out.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            chance[np.arange(len(own)), target[own]] -= 1
            chance /= len(own)
            to_hidden = chance @ layer.T
            by_layer = hidden.T @ chance
            seen_layer += by_layer**2
            layer -= rate * by_layer / np.sqrt(seen_layer)
            bias -= rate * 0.1 * chance.sum(0)
            found, back = np.unique(n, return_inverse=True)
            slope = np.zeros((len(found), width))
            np.add.at(slope, back, to_hidden[row] * v[:, None])
            seen_table[found] += (slope**2).mean(1)
            table[found] -= rate * slope / np.sqrt(seen_table[found])[:, None]
    raw = np.concatenate([forward(judged[i : i + 64])[4] for i in range(0, len(judged), 64)])
    truth = target[judged]

    def chances(temperature):
        z = raw / temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    choices = np.geomspace(0.1, 10, 41)
    losses = [-np.log(chances(t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in choices]
    temperature = float(choices[int(np.argmin(losses))])
    chance = chances(temperature)
    best = chance.max(1)
    right = chance.argmax(1) == truth
    falling = np.argsort(-best, kind="stable")
    reached = np.cumsum(right[falling]) / np.arange(1, len(falling) + 1) >= precision
    accept = float(best[falling][np.flatnonzero(reached)[-1]]) if reached.any() else 1.0
    return LanguageModel(languages, (table @ layer).astype(np.float32), bias, temperature, accept)


def train_languages(
    documents: DataFrame, per_language: int = 700, seed: int = 42
) -> LanguageModel:
    """Fit on about ``per_language`` rows of each language (the documented bound), whole texts."""
    sample = labelled_sample(
        documents.filter(F.col("text").isNotNull()), "doc_id", "lang", per_language, seed
    )
    # At most about per_language short rows of each language.
    chosen = F.broadcast(sample.select("doc_id", F.col("lang").alias("label")))
    texts = documents.select("doc_id", "text").filter(F.col("text").isNotNull())
    texts = texts.join(chosen, "doc_id").select("label", "text")
    bounded_batches(texts)
    rows = texts.mapInPandas(_hashed, "label STRING, numbers BINARY, values BINARY").toPandas()
    return train_embeddings(
        [np.frombuffer(x, np.int32) for x in rows["numbers"]],
        [np.frombuffer(x, np.float32) for x in rows["values"]],
        list(rows["label"]),
        seed=seed,
    )


def predict(model: LanguageModel, texts: list[str | None]) -> pd.DataFrame:
    found, n_letters = _subwords([t if isinstance(t, str) else "" for t in texts])
    if not model.languages:
        n_letters = n_letters * 0
    total = np.zeros((len(texts), model.table.shape[1]))
    size = np.zeros(len(texts))
    for buckets, first, last in found:
        rows = np.concatenate([model.table[buckets], np.zeros((1, total.shape[1]), np.float32)])
        total += span_sums(rows, first, last)
        size += last - first
    z = (total / np.maximum(size, 1)[:, None] + model.bias) / model.temperature
    z = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
    chance = z / z.sum(1, keepdims=True)
    best = chance.argmax(1) if len(z) else np.zeros(0, int)
    known = n_letters > 0
    score = np.where(known, chance[np.arange(len(best)), best], 0.0)
    names = np.array([*model.languages, UNKNOWN], object)
    return pd.DataFrame(
        {
            "lang_pred": names[np.where(known, best, len(model.languages))],
            "score": score,
            "accepted": known & (score >= model.accept_from),
        }
    )


def identified(documents: DataFrame, model: LanguageModel, into: str = "_lang") -> DataFrame:
    """All columns and a struct of ``lang_pred``, ``score`` and ``accepted``."""
    bounded_batches(documents)

    def score(texts: pd.Series) -> pd.DataFrame:
        parts = [predict(model, part) for part in runs([t if isinstance(t, str) else "" for t in texts])]
        return pd.concat(parts, ignore_index=True) if parts else predict(model, [])

    kind = "lang_pred STRING, score DOUBLE, accepted BOOLEAN"
    return documents.withColumn(into, F.pandas_udf(score, kind).asNondeterministic()("text"))
