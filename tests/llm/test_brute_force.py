"""Operators against plain versions of the same contract, on small tables."""

import random
import re
import time
from collections import Counter, defaultdict

import base64
import numpy as np
import pandas as pd
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tallygrove.llm import (
    components,
    decontaminate,
    html_render,
    license_scan,
    line_crf,
    line_dedup,
    mixing,
    quality_rules,
    queries,
    simhash,
    token_shards,
)
from tallygrove.llm.tables import row_key, saved
from tallygrove.sources.scratch import scratch_path

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="module")
def small(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}


def classes(links, nodes):
    above = {n: n for n in nodes}

    def root(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            above[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a LONG, b LONG")
    known = [(a, b) for a, b in edges if a is not None]
    want = classes(known, {x for e in known for x in e})
    got = {r["node"]: r["root"] for r in components.star_forest(df, "a", "b").collect()}
    assert got == {n: r for n, r in want.items() if n != r}


def naive_fingerprint(text):
    words = SPACE.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    got = {r["doc_id"]: r for r in queries.op10_simhash(spark, MEDIUM).collect()}
    texts = {r["doc_id"]: r["text"] for r in table(spark, MEDIUM, "documents").collect()}
    marks = {d: naive_fingerprint(t) for d, t in texts.items()}
    ids = sorted(marks)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (marks[a] ^ marks[b]).bit_count() <= 2
    ]
    want = classes(links, ids)
    assert len(set(want.values())) < len(ids)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in got.items()} == {
        d: (f"{marks[d]:016x}", want[d]) for d in ids
    }


def test_hot_simhash_shard(spark, monkeypatch):
    """A crowd of fingerprints around one, cut into parts, still links as in brute force."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", 7)
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    marks = {centre}
    for _ in range(120):
        x = centre
        for _ in range(rng.choice((1, 2, 3, 5))):
            x ^= 1 << rng.randrange(64)
        marks.add(x)
    marks |= {rng.getrandbits(64) for _ in range(50)}
    signed = {m: m - (1 << 64) if m >> 63 else m for m in marks}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fingerprint LONG")
    links = [(r[0], r[1]) for r in simhash.near_links(df).collect()]
    want = [
        (signed[a], signed[b]) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= 2
    ]
    assert classes(links, signed.values()) == classes(want, signed.values())


def test_bk_tree():
    rng = random.Random(2)
    values = list({rng.getrandbits(12) for _ in range(400)})
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50] + [rng.getrandbits(12) for _ in range(50)]:
        found = sorted(tree.values[i] for i in tree.within(q, 2))
        assert found == sorted(v for v in values if (v ^ q).bit_count() <= 2)


def naive_counts(text):
    words = SPACE.findall(text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if SPACE.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)


def test_quality_counts_and_verdict(spark, small):
    rows = queries.op1_quality_rules(spark, SMALL).collect()
    assert len(rows) == len(small)
    for r in rows:
        want = naive_counts(small[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["tier"] != "reject")


def test_quality_model_on_rows_it_has_not_seen(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality_rules.train_quality(docs, labels.filter(seen))
    judged = quality_rules.judged(docs, model).join(labels.filter(~seen), "doc_id")
    right = judged.filter((F.col("_quality.tier") != "reject") == (F.col("quality") == 1)).count()
    assert right >= 0.97 * judged.count()


@pytest.mark.parametrize("name", ["op4_line_chain_quality"])
def test_line_chain_held_out(spark, name):
    got = queries.QUERIES[name](spark, MEDIUM).join(table(spark, MEDIUM, "labels"), "doc_id")
    rows = got.filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_every_line_is_labelled(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    model = line_crf.fit_line_chain(docs, table(spark, SMALL, "labels"))
    got = line_crf.scored(line_crf.line_labels(docs, model, "lines"), model, "score").collect()
    assert {x["label"] for r in got for x in r["lines"]} == {0, 1}
    for r in got:
        texts = (r["text"] or "").split("\n")
        assert [x["line_no"] for x in r["lines"]] == list(range(len(texts)))
        assert all(x["label"] == (x["probability"] >= 0.5) for x in r["lines"])
        heavy = line_crf.lines_of([r["text"] or ""]).sizes + 1.0
        mean = np.clip(np.average([x["probability"] for x in r["lines"]], weights=heavy), 1e-6, 1 - 1e-6)
        margin = np.clip(model.slope * np.log(mean / (1 - mean)) + model.offset, -40, 40)
        assert np.isclose(r["score"], 1 / (1 + np.exp(-margin)))


def test_chain_marginals():
    rng = np.random.default_rng(0)
    counts, steps = np.array([3, 1, 4]), rng.normal(size=(2, 2))
    margins = rng.normal(size=8)
    good, into = line_crf.marginals(margins, counts, steps)
    at = 0
    for n in counts:
        chance, total, pairs = np.zeros(n), 0.0, np.zeros((n, 4))
        for states in np.ndindex(*(2,) * n):
            weight = np.exp(
                sum(margins[at + i] for i in range(n) if states[i])
                + sum(steps[states[i - 1], states[i]] for i in range(1, n))
            )
            total += weight
            chance += weight * np.array(states)
            for i in range(1, n):
                pairs[i, 2 * states[i - 1] + states[i]] += weight
        assert np.allclose(good[at : at + n], chance / total)
        assert np.allclose(into[at : at + n], pairs / total)
        at += n


def test_language_held_out(spark):
    docs = table(spark, MEDIUM, "documents")
    got = queries.op6_language_id(spark, MEDIUM).join(docs, "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_licences_without_an_index(spark, small):
    word = re.compile(license_scan.WORD)
    for r in queries.op2_license_scan(spark, SMALL).collect():
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), small[r["doc_id"]] or "")
        words = word.findall(lowered)
        base, labels = [], set()
        for t in license_scan.TEMPLATES:
            own = t.words
            for at in range(-len(own), len(words)):
                at_place = [words[at + i] if 0 <= at + i < len(words) else None for i in range(len(own))]
                keyed = all(at_place[i] == own[i] for b, e in t.keys for i in range(b, e))
                if keyed and sum(a == b for a, b in zip(at_place, own)) >= 0.8 * len(own):
                    labels.add(t.label)
                    if t.base:
                        base.append((at, t.label))
        assert (r["n_words"], r["n_base"]) == (len(words), len(base))
        assert r["first_word"] == min((a for a, _ in base), default=None)
        assert r["last_word"] == max((a for a, _ in base), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in base}))
        assert r["labels"] == ",".join(sorted(labels))


def test_licence_texts_with_gaps(spark):
    full = "Permission is hereby granted, free of charge, to any person obtaining a copy of this SOFTWARE"
    other = full.replace("any person", "each one") + " and associated documentation files the software to deal in the software without restriction"
    rows = [(1, full), (2, other), (3, "mit license under the mit license under the mit license"), (4, "CC-BY-NC CC BY NC")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    got = {r["doc_id"]: r for r in license_scan.scanned(df).select("doc_id", "_licence.*").collect()}
    assert got[1]["labels"] == "" and got[2]["labels"] == "mit" and 0.8 <= got[2]["score"] < 1
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (2, 2, 6)
    assert (got[4]["n_base"], got[4]["labels"]) == (2, "cc-by-nc")


def test_bm25_search(spark):
    docs = [r["text"] for r in table(spark, SMALL, "documents").collect()][:120]
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    index = next(iter(decontaminate.indexes(table(spark, SMALL, "benchmark"))))
    bags = [decontaminate.words_of(t) for _, t in items]
    df = Counter(w for b in bags for w in set(b))
    mean = sum(map(len, bags)) / len(bags)

    def impact(word, i):
        n, size = bags[i].count(word), len(bags[i])
        idf = np.log(1 + (len(bags) - df[word] + 0.5) / (df[word] + 0.5))
        k1, b = decontaminate.K1, decontaminate.B
        return idf * n * (k1 + 1) / (n + k1 * (1 - b + b * size / mean))

    own = [sum(impact(w, i) for w in set(b)) for i, b in enumerate(bags)]
    found = 0
    for text in docs:
        words = decontaminate.words_of(text)
        size = index.stretch
        stretches = [words[i : i + size] for i in range(0, len(words), size)]
        want = {}
        for p in range(len(stretches)):
            passage = set(stretches[p] + (stretches[p + 1] if p + 1 < len(stretches) else []))
            for i, bag in enumerate(bags):
                score = sum(impact(w, i) for w in set(bag) & passage) / own[i]
                if score >= 0.2:
                    want[p, i] = score
        ids = np.array([index.numbers.get(w, -1) for w in words], np.int64)
        known = ids >= 0
        joined = np.ones(len(stretches), bool)
        if not len(joined):
            continue
        joined[-1] = False
        got = decontaminate.candidates(
            index, (np.arange(len(words)) // size)[known], ids[known], joined, 0.2
        )
        got = {(p, i): s for p, i, s in zip(*(x.tolist() for x in got))}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
        found += len(want)
    assert found


def test_leaks(spark):
    docs = {r["doc_id"]: decontaminate.words_of(r["text"]) for r in table(spark, MEDIUM, "documents").collect()}
    items = {r["item_id"]: decontaminate.words_of(r["text"]) for r in table(spark, MEDIUM, "benchmark").collect()}
    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in items.items()}
    sure, none = set(), set()
    for d, words in docs.items():
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for i, g in grams.items():
            share = len(g & own) / len(g)
            (sure if share == 1 else none if share < 0.3 else set()).add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontaminate(spark, MEDIUM).collect()}
    assert sure and sure <= got and not got & none


def test_leaks_over_several_index_blocks(spark, monkeypatch):
    whole = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontaminate(spark, MEDIUM).collect()}
    small_blocks = decontaminate.indexes(table(spark, MEDIUM, "benchmark"), 7)
    assert len(list(small_blocks)) > 1
    original = decontaminate.indexes
    monkeypatch.setattr(decontaminate, "indexes", lambda b: original(b, 7))
    assert {(r["doc_id"], r["item_id"]) for r in queries.op7_decontaminate(spark, MEDIUM).collect()} == whole


def naive_shares(budget, children):
    """children: name to (most, weight)."""
    got, open_ = {}, {c: v for c, v in children.items() if v[1] > 0 and v[0] > 0}
    while open_:
        weight = sum(w for _, w in open_.values())
        full = [c for c, (m, w) in open_.items() if m * weight <= budget * w]
        if not full:
            return got | {c: budget * w // weight for c, (_, w) in open_.items()}
        first = min(full, key=lambda c: (open_[c][0] / open_[c][1], c))
        got[first] = open_[first][0]
        budget -= got[first]
        del open_[first]
    return got


@pytest.mark.parametrize("epochs, share", [(1, 0.5), (3, 1.4), (2, 5.0)])
def test_mixing(spark, epochs, share):
    docs = table(spark, MEDIUM, "documents")
    target = queries.TARGET
    chosen = mixing.selection(docs, share, target, max_epochs=epochs).collect()
    rows = docs.select(
        "doc_id", F.coalesce(mixing.source_group(), F.lit("(none)")).alias("domain"), "lang", "source", "text",
        *row_key(docs.columns),
    ).collect()
    tokens = {r["doc_id"]: len(SPACE.findall(r["text"])) for r in rows}
    leaf_of = {r["doc_id"]: (r["domain"], r["lang"], r["source"]) for r in rows}
    totals = Counter()
    for d, leaf in leaf_of.items():
        totals[leaf] += tokens[d]
    most = {leaf: n * epochs for leaf, n in totals.items()}

    def level(prefix, n, budget, weight):
        names = {leaf[n] for leaf in most if leaf[:n] == prefix}
        return naive_shares(
            budget,
            {x: (sum(m for leaf, m in most.items() if leaf[: n + 1] == (*prefix, x)), weight.get(x, 1)) for x in names},
        )

    want, asked = {}, int(share * sum(totals.values()))
    for d, b in level((), 0, min(asked, sum(most.values())), target.domain).items():
        for lang, c in level((d,), 1, b, target.lang).items():
            for s, e in level((d, lang), 2, c, target.source).items():
                want[d, lang, s] = e
    got = Counter()
    for r in chosen:
        got[r["domain"], r["lang"], r["source"]] += r["taken_tokens"]
    assert {k: v for k, v in want.items() if v} == dict(got)
    # Every full epoch is complete; in the last, rows come in hash order and one at most is cut.
    by_leaf = defaultdict(list)
    for r in chosen:
        by_leaf[r["domain"], r["lang"], r["source"]].append(r)
    keys = {r["doc_id"]: (r["_key1"], r["_key2"]) for r in rows}
    hashes = spark.createDataFrame(
        [(d, leaf[0], e, *keys[d]) for d, leaf in leaf_of.items() for e in range(epochs + 1)],
        "doc_id LONG, leaf STRING, e LONG, k1 LONG, k2 LONG",
    ).select("doc_id", "e", F.xxhash64(F.lit(42), "e", "k1", "k2").alias("h")).collect()
    order = {(r["doc_id"], r["e"]): r["h"] % 2**64 for r in hashes}
    for leaf, own in by_leaf.items():
        members = {d for d, x in leaf_of.items() if x == leaf and tokens[d]}
        last = want[leaf] // totals[leaf]
        for e in range(last):
            assert {r["doc_id"] for r in own if r["epoch"] == e} == members
        partial = {r["doc_id"]: r["taken_tokens"] for r in own if r["epoch"] == last}
        left = want[leaf] % totals[leaf]
        for d in sorted(members, key=lambda d: order[d, last]):
            take = min(tokens[d], left)
            assert partial.get(d, 0) == take
            left -= take


def test_shares_of_huge_budgets(spark):
    rows = [(1, f"s{i}", (i + 1) * 10**14, 10**6 + i, 9 * 10**14) for i in range(6)]
    df = spark.createDataFrame(rows, "p INT, name STRING, _most LONG, _weight LONG, _budget LONG")
    got = {r["name"]: r["_share"] for r in mixing.share_out(df, ["p"], "name").collect()}
    assert got == naive_shares(9 * 10**14, {r[1]: (r[2], r[3]) for r in rows})


def test_mixed_documents(spark):
    docs = table(spark, MEDIUM, "documents")
    taken = mixing.selection(docs, 0.5, queries.TARGET).collect()
    want = Counter({r["doc_id"]: r["taken_tokens"] for r in taken})
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixing.mixed(docs, 0.5, queries.TARGET).collect():
        assert texts[r["doc_id"]].startswith(r["text"])
        assert len(SPACE.findall(r["text"])) == want.pop(r["doc_id"])
    assert not want


@pytest.mark.parametrize("count", [1, 2, 3, 17, 1000, 4097])
def test_permutation(count):
    order = token_shards.Permutation(count, 7)
    slots = order.slots(np.arange(count))
    assert sorted(slots) == list(range(count))
    assert (order.sequences(slots) == np.arange(count)).all()


def test_pieces_of_odd_texts():
    own = token_shards.tokenizer(open(token_shards.VOCABULARY, "rb").read())
    rng = random.Random(4)
    marks = "aZéßØ×÷ªµº²½ 0 9\t\n\r\x0b\x0c\x1c\x1f\x00\x85\xa0\u1680\u2003日本\U0001f600'’s't're.,!?-_#ſƀɏɐ"
    texts = ["".join(rng.choice(marks) * rng.choice((1, 1, 1, 2, 3)) for _ in range(rng.randrange(14))) for _ in range(6000)]
    texts += ["", " ", "a ", " a", "a  b", "a\n b", "a\n \nb", "x\xa0 y", "it's 'tis", "a\nb c\n\nd", "one two one"]
    for text in texts:
        assert own.encode(text) == own.any_text(text), repr(text)


def test_shards_round_trip(spark):
    docs = table(spark, MEDIUM, "documents")
    shards = token_shards.write_shards(docs, scratch_path(spark, "shards"), 256, 100)
    read = token_shards.read_shards(spark, shards).orderBy("slot").collect()
    pairs = (x.split() for x in open(token_shards.VOCABULARY, "rb"))
    plain = tiktoken.Encoding(
        "plain",
        pat_str=token_shards.PATTERN,
        mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs},
        special_tokens={},
    )
    stream = []
    for r in docs.select("text").collect():
        stream += plain.encode_ordinary(r["text"]) + [token_shards.END]
    assert shards.n_tokens == len(stream)
    stream += [token_shards.END] * (-len(stream) % 256)
    assert [r["slot"] for r in read] == list(range(len(stream) // 256))
    assert [r["place"] for r in read] == [(r["slot"] % 100) * 512 for r in read]
    back = sorted(read, key=lambda r: r["sequence"])
    assert np.frombuffer(b"".join(bytes(r["tokens"]) for r in back), "<u2").tolist() == stream
    later = token_shards.read_shards(spark, shards, from_slot=250).orderBy("slot").collect()
    assert later == read[250:]
    assert {r["shard"]: r["bytes"] for r in shards.manifest.collect()}[0] == 100 * 512


def test_fuzzy_lines(spark):
    docs = table(spark, SMALL, "documents")
    lines = [(r["doc_id"], i, x) for r in docs.collect() for i, x in enumerate((r["text"] or "").split("\n"))]
    texts = sorted({x for *_, x in lines if SPACE.search(x)})
    sets = {x: {x[i : i + 5] for i in range(len(x) - 4)} for x in texts}
    holders = defaultdict(list)
    for x in texts:
        for s in sets[x]:
            holders[s].append(x)
    shared = Counter()
    for found in holders.values():
        for i, a in enumerate(found):
            for b in found[i + 1 :]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    want, first = classes(links, texts), {}
    gone = defaultdict(set)
    for d, i, x in sorted(lines):
        if x in want and first.setdefault(want[x], (d, i)) != (d, i):
            gone[d].add(i)
    got = {r["doc_id"]: set(r["dropped"]) for r in line_dedup.line_report(docs).collect()}
    n_want, n_got = sum(map(len, gone.values())), sum(map(len, got.values()))
    assert all(got[d] <= gone[d] for d in got) and n_got >= 0.99 * n_want > 0
    cleaned = {r["doc_id"]: r["text"] for r in line_dedup.without_near_lines(docs).collect()}
    for d in got:
        kept = [x for e, i, x in lines if e == d and i not in got[d]]
        assert cleaned[d] == "\n".join(kept)


def test_one_edit_in_short_lines(spark):
    """One changed character in 62, one swapped word in 97: near by 5-character shingles, not by 8."""
    rng = random.Random(11)
    rows = []
    for i in range(30):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(23)]
        short, long = " ".join(words[:9]), " ".join(words[9:])
        rows += [(4 * i, short), (4 * i + 1, short[:30] + "9" + short[31:])]
        rows += [(4 * i + 2, long), (4 * i + 3, long.replace(words[15], "999999"))]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    sets = {d: {x[i : i + 5] for i in range(len(x) - 4)} for d, x in rows}
    near = [d for d in sets if d % 2 and len(sets[d] & sets[d - 1]) >= 0.8 * len(sets[d] | sets[d - 1])]
    assert len(near) == 60
    found = line_dedup.line_report(docs).collect()
    gone = {r["doc_id"] for r in found if r["dropped"]}
    assert gone <= set(near) and len(gone) >= 59
    assert not any(r["dropped"] for r in line_dedup.line_report(docs, shingle=8).collect())


def naive_dropped(docs, size):
    """Numbers of the lines that go, by comparing all lines that share a shingle."""
    lines = [(r["doc_id"], i, x) for r in docs for i, x in enumerate((r["text"] or "").split("\n"))]
    texts = sorted({x for *_, x in lines if SPACE.search(x)})
    sets = {x: {x[i : i + size] for i in range(len(x) - size + 1)} for x in texts}
    holders = defaultdict(list)
    for x in texts:
        for s in sets[x]:
            holders[s].append(x)
    shared = Counter((a, b) for found in holders.values() for i, a in enumerate(found) for b in found[i + 1 :])
    links = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    group, first, gone = classes(links, texts), {}, set()
    for d, i, x in sorted(lines):
        if x in group and first.setdefault(group[x], (d, i)) != (d, i):
            gone.add((d, i))
    return gone


def test_line_query_finds_one_word_edits(spark):
    docs = table(spark, SMALL, "documents").collect()
    want = naive_dropped(docs, 5)
    got = {(r["doc_id"], i) for r in queries.op5_line_dedup(spark, SMALL).collect() for i in r["dropped"]}
    assert got == want and want - naive_dropped(docs, 8)


def test_large_line_buckets(spark, monkeypatch):
    rng = random.Random(3)
    base = " ".join(f"w{rng.randrange(1000)}" for _ in range(60))
    rows = [(i, base.replace(f" {base.split()[i % 50]} ", f" x{i} ", 1)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    monkeypatch.setattr(line_dedup, "BUCKET_LINES", 5)
    kept = [r["doc_id"] for r in line_dedup.line_report(docs).collect() if r["n_kept"]]
    assert kept == [0]


PAGES = {
    "<p>one<p>two  <b>bold</b>\n text<br>next": "one\n\ntwo bold text\nnext",
    "<ul><li>a<li>b<ul><li>c</ul></ul><ol start=3><li>x<li><p>y</p><p>z</ol>": "- a\n- b\n  - c\n\n3. x\n4. y\n\n   z",
    "<table><tr><th>Name<th>Qty<tr><td>apple<td>3</table>": "Name   Qty\napple  3",
    "<table><tr><td rowspan=2>r<td>1<tr><td>2</table>": "r  1\n   2",
    "<div hidden>no</div>a<div style='display: none'>no</div><script>x='</p>'</script>b": "ab",
    "<head><title>t</title></head><body>x &amp; &lt;y&gt;&nbsp;z</body>": "x & <y> z",
    "<pre> a  b\n   c</pre>": " a  b\n   c",
    "<details><summary>S</summary>hidden</details><details open><summary>T</summary>shown</details>": "S\nT\nshown",
    "3 < 4 <!-- gone": "3 < 4",
    "<dl><dt>a<dd>b<dt>c<dd>d</dl>": "a\n  b\nc\n  d",
    "": "",
    "<div></div>": "",
}


@pytest.mark.parametrize("source", PAGES)
def test_layout(source):
    assert html_render.visible_text(source) == PAGES[source]


LOOSE = {
    "<table><tbody><form><tr><td>x</td><td>y</td></tr></form></tbody></table>": "x  y",
    "<table><tbody>note<tr><td>5</td></tr></tbody></table>": "note\n5",
    "<table><tbody><div>note</div><tr><td>5</td></tr></tbody></table>": "note\n5",
    "<table><tr>Total: <td>5</td></tr><tr>Sum:<td>6</td>end</tr></table>": "Total:\nSum: end\n5\n6",
    "<table><tbody><caption>C</caption><tr><td>5</td></tr></tbody></table>": "C\n5",
    "<table><caption>C<tr><td>a<td>b<tr><td>c<td>d</table>": "C\na  b\nc  d",
    "<table><tr><form><td>a<td>b</form></tr><tr><td>long<td>d</tr></table>": "a     b\nlong  d",
    "<table><form><td>a</td><td>b</td></form></table>": "a  b",
    "<table><tr><b>bold</b><td>5</table>": "bold\n5",
    "<table><tbody hidden>no<tr><td>no</tbody><tbody><tr hidden>no<td>no</tr><tr><td>y</table>": "y",
    "<table><tr>in<table><tr><td>n</table><td>5</table>": "in\n\nn\n5",
}


@pytest.mark.parametrize("source", LOOSE)
def test_words_outside_cells(source):
    assert html_render.visible_text(source) == LOOSE[source]


def test_wide_cells_stay_aligned():
    words = " ".join(f"word{i}" for i in range(30))
    url = "http://x/" + "y" * 90
    source = (
        f"<table><tr><th>Text<th>Qty<th>Note<tr><td>{words}<td>3<br>4<td>{words}"
        f"<tr><td>short<td>5<td>n<tr><td>{url} after<td>6<td>m<tr><td colspan=2>{words}<td>k</table>"
    )
    lines = html_render.visible_text(source).split("\n")
    second = lines[0].index("Qty")
    third = lines[0].index("Note")
    assert second <= html_render.WIDE + 2
    for mark in "3456":
        assert any(line[second:].split()[:1] == [mark] for line in lines), mark
    for mark in ("n", "m", "k", words):
        assert any(line[third:] == mark for line in lines), mark
    assert url in lines
    want = re.sub("<[^>]*>", " ", source).split()
    assert Counter(want) == Counter(" ".join(lines).split())


def test_deep_and_broken_pages():
    assert html_render.visible_text("<div>" * 50_000 + "deep") == "deep"
    assert html_render.visible_text("<ul><li>" * 3_000 + "deep").endswith("deep")
    assert html_render.visible_text("<" * 10_000) == "<" * 10_000
    html_render.visible_text("<a href=\"" * 2_000)
    html_render.visible_text("<table><tr><td>" * 2_000)
    html_render.visible_text("</p></table></div>" * 1_000)


def test_unfinished_tags_take_linear_time():
    begin = time.perf_counter()
    for source in ('<a b="x" ' * 120_000, "<p>shown</p>" + "<i title='y' " * 80_000):
        assert html_render.visible_text(source) == source.replace("<p>shown</p>", "shown\n\n").rstrip()
    assert time.perf_counter() - begin < 5
    assert html_render.visible_text("<p>a</p>b &amp; <c<!-- not <d") == "a\n\nb & <c"


def test_every_visible_word_is_kept(spark):
    pages = table(spark, SMALL, "pages")
    assert {r["page_id"]: r["n_chars"] > 0 for r in queries.op3_html_render(spark, SMALL).collect()} == {
        r["page_id"]: True for r in pages.collect()
    }
    for r in pages.collect():
        source = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>|<style.*?</style>", " ", r["html"])
        import html

        want = html.unescape(re.sub(r"<[^>]*>", " ", source)).split()
        got = html_render.visible_text(r["html"]).split()
        missing = Counter(want) - Counter(got)
        assert sum(missing.values()) <= 0.02 * len(want) + 3, (r["page_id"], missing)


def test_saved_tables_keep_rows(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a LONG, b STRING")
    assert sorted(map(str, saved(df, "t").collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("held, large, size", [(10_000, 1_000, 7), (10_000, 1_000, 1), (20, 2, 3), (1, 5, 50)])
def test_shared_buckets_in_batches(monkeypatch, held, large, size):
    monkeypatch.setattr(line_dedup, "HELD", held)
    monkeypatch.setattr(line_dedup, "LARGE", large)
    rng = random.Random(6)
    hot = (2**32 - 5, 3, 3, 3, 9)
    rows = [(i, rng.choice((*hot, rng.randrange(100))), rng.getrandbits(60)) for i in range(3) for _ in range(90)]
    rows += [rows[i] for i in range(0, 270, 9)]
    rows.sort(key=lambda r: r[0])
    blobs = []
    for part in range(3):
        entries = np.array([r[1:] for r in rows if r[0] == part], line_dedup.ENTRY)
        blobs += [(part, entries[i : i + size].tobytes()) for i in range(0, len(entries), size)]
    frame = pd.DataFrame(blobs, columns=["part", "entries"])
    got = pd.concat(line_dedup._shared(iter([frame[:5], frame[5:]])))
    by_bucket, by_name = defaultdict(set), defaultdict(set)
    for part, bucket, h1 in rows:
        by_bucket[part, bucket].add(h1)
    for bucket, h1 in zip(got["bucket"], got["h1"]):
        by_name[bucket].add(h1)
    assert sorted(map(sorted, by_name.values())) == sorted(sorted(m) for m in by_bucket.values() if len(m) > 1)
