"""Conversation repair against brute force: every sequence of edits, and a parse with all splits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from tallygrove.llm import queries, turn_repair

SMALL = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
FORM = re.compile(r"(s?(ua)+)?")


def best_edits(kinds):
    """(cost, audit, roles) by trying every sequence of edits, with few insertions."""
    best = None
    inserts = ["", "Iu", "Ia", "IuIa", "IaIu"]
    choices = []
    for initial, truncated, must_go in kinds:
        rows = [(2, "D", "")]
        if not must_go:
            extra = 5 if truncated else 0
            rows += [(extra, "K", initial), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
        choices.append(rows)
    for edits in product(*choices):
        for gaps in product(inserts, repeat=len(kinds) + 1):
            cost = sum(e[0] for e in edits) + sum(5 * g.count("I") for g in gaps)
            if best and cost > best[0]:
                continue
            audit = "".join("I" * g.count("I") + e[1] for g, e in zip(gaps, (*edits, (0, "", ""))))
            roles = "".join(g.replace("I", "") + e[2] for g, e in zip(gaps, (*edits, (0, "", ""))))
            if FORM.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, roles)
    return best


def kind_of(initial, truncated, must_go):
    kind = initial if initial in "sua" else "-"
    return "x" if must_go else turn_repair.CAPITAL[kind] if truncated else kind


def test_smallest_cells():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.random() < 0.3, rng.random() < 0.2) for _ in range(rng.randrange(5))]
        cost, audit, roles = best_edits(rows)
        found = turn_repair.cheapest(turn_repair.span_cell("".join(kind_of(*r) for r in rows)))
        assert found == (cost, audit)
        assert "".join(i for _, i in turn_repair.edited_initials(audit)) == roles


def all_splits(kinds):
    """The textbook parse: every span, every split."""
    n, chart = len(kinds), {}
    for size in range(1, n + 1):
        for i in range(n - size + 1):
            cell = {}
            if size == 1:
                cell = turn_repair.row_cell(kinds[i])
            for k in range(i + 1, i + size):
                for pair, (cost, audit) in turn_repair.joined(chart[i, k], chart[k, i + size]).items():
                    turn_repair._offer(cell, pair, cost, audit)
            chart[i, i + size] = cell
    return chart[0, n] if n else turn_repair.insertions()


def test_one_split_is_enough():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 7, 15, 33, 40):
        for _ in range(4):
            kinds = "".join(rng.choice("suaxSUA-_") for _ in range(n))
            assert turn_repair.span_cell(kinds) == all_splits(kinds)


def naive(rows):
    """The contract for one conversation, by a forward search over its rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, kinds, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        seen_chars = BLANK.findall(text)
        fault = (
            "blank" if not seen_chars
            else "duplicate" if (role, text) in seen
            else "truncated" if seen_chars[-1] not in ".!?"
            else None
        )
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        kinds.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(4):
            for state, (cost, audit, out) in list(best.items()):
                for to in steps[state]:
                    if to != "s":
                        offer(best, to, (cost + 5, audit + "I", (*out, ROLE[to] + ":")))

    def offer(best, state, value):
        if state not in best or value[:2] < best[state][:2]:
            best[state] = value

    insert(best)
    for (initial, truncated, must_go), (_, role, text) in zip(kinds, rows):
        after = {}
        for state, (cost, audit, out) in best.items():
            offer(after, state, (cost + 2, audit + "D", out))
            if must_go:
                continue
            extra = 5 if truncated else 0
            for to in steps[state]:
                if to == initial:
                    offer(after, to, (cost + extra, audit + "K", (*out, f"{role}:{text}")))
                if to != "s":
                    offer(after, to, (cost + 1 + extra, audit + "R", (*out, f"{ROLE[to]}:{text}")))
        best = after
        insert(best)
    cost, audit, out = min(best[s] for s in ("", "a") if s in best)
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *counts.values(), illegal, cost, audit, digest)


ROLE = {"u": "user", "a": "assistant"}


def naive_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def naive_report(rows):
    by_conv = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in naive_damage(rows):
        by_conv[conv].append((turn, role, text))
    return {conv: naive(own) for conv, own in by_conv.items()}


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def reported(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    df = queries.op13_turn_repair(spark, sf_dir)
    assert df.columns == ["conv_id", *COLUMNS]
    assert reported(df) == naive_report(rows)


SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, _said STRING, n INT, `a.b` STRING, audit STRING"


def awkward_rows():
    rng = random.Random(8)
    texts = ["Yes.", "No", "", " \t\n", None, "ok.  \n", "ünïcode 𝒳!", "long " * 40_000 + "end."]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    rows = [
        (rng.choice((None, *range(25))), turn, rng.choice(roles[:3] * 3 + roles), rng.choice(texts))
        for turn in range(260)
    ]
    rows += [(100, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(700)]
    rows += [(101, None, "user", "Same."), (102, 5, "user", "Hello")]
    # Rows of one turn stand in the order of role and hash; equal rows are alike in any order.
    return rows + [(103, 7, "user", "Again.")] * 50 + [(103, 9, "user", "Again.")] * 3


def awkward(spark):
    rows = [(*r, "a", 1, "b", "c") for r in awkward_rows()]
    return spark.createDataFrame(rows, SCHEMA)


def test_awkward_conversations(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "CHUNK", 16)
    docs = awkward(spark)
    got = reported(turn_repair.report(turn_repair.damaged(docs), docs))
    assert got == naive_report(awkward_rows())
    # Undamaged rows, by the operator's own interface.
    plain = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in awkward_rows()]
    by_conv = {}
    for conv, *row in plain:
        by_conv.setdefault(conv, []).append(tuple(row))
    assert reported(turn_repair.report(docs, docs)) == {c: naive(own) for c, own in by_conv.items()}


def test_repaired_rows_are_well_formed(spark):
    rows = turn_repair.repaired_rows(turn_repair.damaged(awkward(spark))).orderBy("conv_id", "place").collect()
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r["conv_id"], []).append(r)
    for own in by_conv.values():
        assert [r["place"] for r in own] == list(range(len(own)))
        assert FORM.fullmatch("".join(r["role"][0] for r in own))
        assert all(r["turn"] is None and r["text"] == "" for r in own if r["edit"] == "I")


def test_a_conversation_over_many_tasks(spark):
    """Stretches of one conversation are parsed apart and give what one parse gives."""
    rows = [(1, t, ("user", "assistant")[t % 2 if t % 37 else 0], f"{t}" + "." * (t % 11 > 0)) for t in range(5000)]
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = reported(turn_repair.report(df, df))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {1: naive([r[1:] for r in rows])}


def test_empty_conversations(spark):
    none = awkward(spark).filter(F.lit(False))
    assert turn_repair.report(none, none).collect() == []
    assert turn_repair.repaired_rows(none).collect() == []
    only = spark.createDataFrame([(7, 1, "user", "x")], "conv_id LONG, turn LONG, role STRING, text STRING")
    assert reported(turn_repair.report(none, only)) == {
        7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    }
