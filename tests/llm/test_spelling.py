"""Spelling variants against plain counting and a dictionary of deletions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import rows as R
from pyspark.sql import functions as F

from tallygrove.llm import queries, spelling

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def naive_counts(rows, slips=199):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return counts


def naive_near(words):
    """Words one edit apart, by what is left after any one deletion."""
    left = defaultdict(set)
    for w in words:
        left[w].add((w, -1))
        for i in range(len(w)):
            left[w[:i] + w[i + 1 :]].add((w, i))
    near = defaultdict(set)
    for group in left.values():
        for a, i in group:
            for b, j in group:
                if a != b and (i == j or -1 in (i, j)):
                    near[a].add(b)
    return near


def naive_variants(counts, least=5, ratio=5):
    counts = {w: n for w, n in counts.items() if n >= least}
    near, forms, out = naive_near(counts), {}, {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        form = forms[w]
        out[w] = (form, root, n, len(near[w]), counts[form] if form is not None else None)
    return out


COLUMNS = ("form", "root", "n", "n_near", "form_n")


def found(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[c] for c in COLUMNS) for r in rows}


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = queries.op11_spelling_variants(spark, sf_dir)
    assert df.columns == ["word", *COLUMNS]
    want = naive_variants(naive_counts(docs))
    assert found(df) == want
    assert any(form for form, *_ in want.values())


def edits_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("alphabet,longest", [("ab", 9), ("aé𝒳b", 7), ("abcdefgh", 5)])
def test_search_schemes(alphabet, longest):
    """Both searches together find every near word once, runs of equal letters included."""
    rng = random.Random(longest)
    words = sorted({"".join(rng.choices(alphabet, k=rng.randint(2, longest))) for _ in range(400)})
    asked = list(dict.fromkeys(words + ["".join(rng.choices(alphabet + "z", k=4)) for _ in range(40)]))
    counts = {w: rng.randint(1, 30) for w in words}
    got = defaultdict(list)
    for backwards in (False, True):
        for q, size, n, best in spelling.near_best(words, list(counts.values()), asked, backwards):
            got[q].append((size, -n, best))
    for q in asked:
        near = [w for w in words if edits_apart(q, w)]
        assert sum(size for size, _, _ in got[q]) == len(near)
        if near:
            assert min(g[1:] for g in got[q]) == min((-counts[w], w) for w in near)


def test_suffix_order():
    rng = random.Random(2)
    for width in (2, 4, 200):
        symbols = [rng.randrange(1, width) for _ in range(300)] + [1] * 50 + [0]
        import numpy as np

        got = spelling.suffix_order(np.array(symbols), width).tolist()
        assert got == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_crowded_half(spark, monkeypatch):
    """A half that most words share is cut into parts, and chains of forms are followed to the end."""
    monkeypatch.setattr(spelling, "SHARD_WORDS", 40)
    monkeypatch.setattr(spelling, "BLOCK", 16)
    rng = random.Random(6)
    words = {"common" + "".join(rng.choices("abc", k=rng.randint(4, 6))): rng.randint(5, 5000) for _ in range(400)}
    words |= {"".join(rng.choices("xyz", k=rng.randint(6, 8))) + "ending": rng.randint(5, 900) for _ in range(300)}
    words |= {"chains" + "d" * i: 5**(7 - i) for i in range(7)}
    words |= {"z" * 3000 + "q" * i: 10 * 9**i for i in range(3)}
    df = spark.createDataFrame(list(words.items()), "word STRING, n LONG")
    got = found(spelling.variants(df))
    assert got == naive_variants(words)
    assert got["chainsddddd"][1] == "chains"


def test_awkward_documents(spark):
    docs = R.awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for slips in (199, 3):
        got = {r["word"]: r["n"] for r in spelling.word_counts(docs, slips=slips).collect()}
        assert got == naive_counts(rows, slips)
    # No slip: a divisor beyond every checksum but 0.
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()} == naive_counts(rows, 1 << 40)
    assert found(spelling.variants(spelling.word_counts(docs, slips=3), least=1)) == naive_variants(
        naive_counts(rows, 3), least=1
    )


def test_no_words(spark):
    assert spelling.variants(spelling.word_counts(R.empty(spark), slips=199)).collect() == []
    short = R.awkward(spark).filter(F.col("text") == "x")
    assert spelling.variants(spelling.word_counts(short)).collect() == []


def test_ratio_has_a_lower_limit(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("abcdef", 9)], "word STRING, n LONG"), ratio=1)
