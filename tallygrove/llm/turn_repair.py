"""Conversation structure repair by weighted interval parsing.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: an optional system row,
then user and assistant in turn. Edits of a row are Keep (0), Rerole to user or assistant (1) and Delete
(2); blank and duplicate rows must be deleted, a truncated row that stays costs 5 more, and an empty
user or assistant row may be inserted anywhere (5). The cheapest edits are found, of equally cheap ones
those whose initials come first in ASCII order.

The grammar is in Chomsky normal form. A nonterminal is a pair of states of the pattern: ``(p, q)``
derives every edited span that leads from p to q. Its rules are ``(p, q) -> (p, r) (r, q)``; its terminals
are the edits of one row, closed under insertions on both sides. A span's cell holds the smallest (cost,
audit) per nonterminal. Because each pair of states has its own nonterminal, every split of a span gives
the same cell, so the parse needs one split per span: spans of 1, 2, 4, ... rows are combined bottom-up
and the work grows with the rows, not with their cube. Smallest cells may be combined, since of two
audits of one span that cost the same neither is the beginning of the other: it would lack insertions.

Rows are judged without their text: by the role, two hashes of the text, and whether it is blank or
complete. These short rows are counted together where equal, sorted by ranges of (conversation, turn),
so a conversation may span many tasks, and each task parses its stretch in chunks of ``CHUNK`` rows.
Per conversation only the chunks' cells meet, whose size is that of the result's audit. Texts are
shuffled once, when the repaired rows are read out in order; they stream through, and only the audit is
held. (A digest of the whole conversation can be computed in no other order.)

Rows of a conversation are taken by turn, nulls first; rows of the same turn by role, then by the text's
hash. A null role or text counts as one space. A null ``conv_id`` is a conversation of its own. Equal
rows are duplicates. Other columns are not used and not returned. A conversation without rows is empty
and well formed. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrove.llm.tables import saved

# The states of the pattern, its steps, where it may end, and the costs of edits.
START, SYSTEM, USER, REPLY = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): REPLY, (REPLY, "u"): USER}
ENDS = (START, REPLY)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"
# Rows that a task parses before it passes a cell on, and rows whose cell is remembered as a whole.
CHUNK, SPAN = 100_000, 32

# The kinds of rows: the role's initial (``-`` for others), as a capital (``_``) if truncated, ``x`` if it
# must go. A cell maps nonterminals to (cost, audit).
GONE = "x"
CAPITAL = {"s": "S", "u": "U", "a": "A", "-": "_"}
PLAIN = {v: k for k, v in CAPITAL.items()}
Cell = dict[tuple[int, int], tuple[int, str]]


def _offer(cell: Cell, pair: tuple[int, int], cost: int, audit: str) -> None:
    known = cell.get(pair)
    if known is None or (cost, audit) < known:
        cell[pair] = (cost, audit)


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans in a row, by all rules ``(p, q) -> (p, r) (r, q)``."""
    cell: Cell = {}
    for ((p, r), (cost, audit)), ((s, q), (more, rest)) in product(left.items(), right.items()):
        if r == s and ((p, q) not in cell or cost + more <= cell[p, q][0]):
            _offer(cell, (p, q), cost + more, audit + rest)
    return cell


@cache
def insertions() -> Cell:
    """The closure of insertions: the cell of a span without rows."""
    cell: Cell = {(p, p): (0, "") for p in (START, SYSTEM, USER, REPLY)}
    for (p, initial), q in STEPS.items():
        if initial in ROLES:
            _offer(cell, (p, q), INSERT, "I")
    while (wider := joined(cell, cell)) != cell:
        cell = wider
    return cell


@cache
def row_cell(kind: str) -> Cell:
    """The edits of one row, with insertions before and after."""
    cell: Cell = {(p, p): (DELETE, "D") for p in (START, SYSTEM, USER, REPLY)}
    if kind != GONE:
        extra = TRUNCATED if kind in PLAIN else 0
        for (p, initial), q in STEPS.items():
            if initial == PLAIN.get(kind, kind):
                _offer(cell, (p, q), extra, "K")
            if initial in ROLES:
                _offer(cell, (p, q), REROLE + extra, "R")
    return joined(joined(insertions(), cell), insertions())


def _combined(cells: list[Cell]) -> Cell:
    """Neighbouring spans are joined until one is left."""
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0] if cells else insertions()


@lru_cache(maxsize=1 << 15)
def _short_span(kinds: str) -> Cell:
    return _combined([row_cell(k) for k in kinds])


def span_cell(kinds: str) -> Cell:
    """The cell of a span of rows given by their kinds."""
    return _combined([_short_span(kinds[i : i + SPAN]) for i in range(0, len(kinds), SPAN)])


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the best repair of a whole conversation."""
    return min(cell[START, q] for q in ENDS)


def edited_initials(audit: str) -> Iterator[tuple[str, str]]:
    """(edit, initial of the resulting role) of each edit; a deleted row has no initial."""
    left = len(audit) - audit.count("D")
    first, at = "s" if left % 2 else "u", 0
    for edit in audit:
        if edit == "D":
            yield edit, ""
        else:
            yield edit, first if at == 0 else ("ua"[at % 2] if first == "u" else "au"[at % 2])
            at += 1


def damaged(conversations: DataFrame) -> DataFrame:
    """Faults set in by a checksum of conversation and turn; see the contract of the query."""
    key = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    )
    fault = F.pmod(F.crc32(key), F.lit(20))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(True), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))).alias("_"),
    ).drop("_")


ORDER = ("conv_id", "turn", "role", "h1", "h2")


def _rows(conversations: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    h1, h2 = F.xxhash64(F.lit(1), text).alias("h1"), F.xxhash64(F.lit(2), text).alias("h2")
    return conversations.select("conv_id", "turn", role.alias("role"), h1, h2, text.alias("text"))


def judged_rows(conversations: DataFrame) -> DataFrame:
    """Equal rows once, with their number ``n``: blank, seen earlier, complete; texts as two hashes."""
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = _rows(conversations).select(
        *ORDER, (core == "").alias("blank"), F.right(core, F.lit(1)).isin(*".!?").alias("complete")
    )
    once = saved(rows.groupBy(*ORDER, "blank", "complete").agg(F.count("*").alias("n")), "turns")
    # Texts that a role says in more than one turn: where it does so first.
    said = once.groupBy("conv_id", "role", "h1", "h2").agg(
        F.count("*").alias("_turns"), F.min("turn").alias("_first"), F.count("turn").alias("_known")
    )
    again = said.filter("_turns > 1").select(
        F.struct("conv_id", "role", "h1", "h2").alias("_said"), "_first", (F.col("_known") < F.col("_turns")).alias("_null")
    )
    tagged = once.withColumn("_said", F.struct("conv_id", "role", "h1", "h2"))
    earlier = F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_first"))
    found = tagged.join(again, "_said", "left")
    return found.select(
        *ORDER, "blank", "complete", "n", F.coalesce(earlier, F.lit(False)).alias("earlier")
    )


def _chunk_schema(conversations: DataFrame) -> T.StructType:
    fields = {f.name: f.dataType for f in conversations.schema.fields}
    return (
        T.StructType()
        .add("conv_id", fields["conv_id"])
        .add("turn", fields["turn"])
        .add("role", T.StringType())
        .add("h1", T.LongType())
        .add("h2", T.LongType())
        .add("first_turn", fields["turn"])
        .add("last_turn", fields["turn"])
        .add("turns", T.LongType())
        .add("blank", T.LongType())
        .add("duplicate", T.LongType())
        .add("truncated", T.LongType())
        .add("illegal", T.LongType())
        .add("initials", T.ArrayType(T.StringType()))
        .add("cell", T.ArrayType(CELL))
    )


CELL = (
    T.StructType()
    .add("p", T.IntegerType())
    .add("q", T.IntegerType())
    .add("cost", T.LongType())
    .add("audit", T.StringType())
)


def _stored(cell: Cell) -> list[dict]:
    return [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in sorted(cell.items())]


class _Chunk:
    """A stretch of one conversation in order, as what is needed to put stretches together."""

    def __init__(self, row: dict):
        self.out = {c: row[c] for c in ORDER}
        self.out |= dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
        self.kinds: list[str] = []
        self.size = 0
        self.first = self.last = None
        self.out |= {"first_turn": None, "last_turn": None}

    def add(self, row: dict) -> None:
        """The next rows, ``n`` equal ones."""
        out, initial, n = self.out, row["role"][:1], row["n"]
        if row["turn"] is not None and (not out["turns"] or row["turn"] != out["last_turn"]):
            if not out["turns"]:
                out["first_turn"] = row["turn"]
            out["turns"] += 1
            out["last_turn"] = row["turn"]
        kind = initial if initial in CAPITAL else "-"
        repeated = n if row["earlier"] else n - 1
        if row["blank"]:
            out["blank"] += n
            self.kinds.append(GONE * n)
        else:
            out["duplicate"] += repeated
            if repeated < n:
                out["truncated"] += not row["complete"]
                self.kinds.append(kind if row["complete"] else CAPITAL[kind])
            self.kinds.append(GONE * repeated)
        if self.last is None:
            self.first = initial
        else:
            out["illegal"] += self.last + initial not in LEGAL
        out["illegal"] += n - 1
        self.last = initial
        self.size += n

    def done(self) -> dict:
        ends = [self.first, self.last]
        return self.out | {"initials": ends, "cell": _stored(span_cell("".join(self.kinds)))}


def _chunks(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    chunk: _Chunk | None = None
    for batch in batches:
        ready = []
        for row in batch.to_pylist():
            if chunk and (chunk.size >= CHUNK or chunk.out["conv_id"] != row["conv_id"]):
                ready.append(chunk.done())
                chunk = None
            chunk = chunk or _Chunk(row)
            chunk.add(row)
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)
    if chunk:
        yield pa.RecordBatch.from_pylist([chunk.done()], schema)


def _parsed(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Put the chunks of each conversation together."""
    for batch in batches:
        ready = []
        for row in batch.to_pylist():
            out = {"conv_id": row["conv_id"], "gaps": 0}
            sums = ("blank", "duplicate", "truncated", "illegal")
            out |= {c: sum(chunk[c] for chunk in row["chunks"]) for c in sums}
            cells, initial, turn, low, turns = [], None, None, None, 0
            for chunk in row["chunks"]:
                first, last = chunk["initials"]
                out["illegal"] += initial is not None and initial + first not in LEGAL
                initial = last
                if chunk["turns"]:
                    begin = chunk["first_turn"]
                    turns += chunk["turns"] - (turn is not None and begin == turn)
                    low = begin if low is None else low
                    turn = chunk["last_turn"]
                cells.append({(e["p"], e["q"]): (e["cost"], e["audit"]) for e in chunk["cell"]})
            if turns:
                out["gaps"] = turn - low + 1 - turns
            out["cost"], out["audit"] = cheapest(_combined(cells))
            ready.append(out)
        yield pa.RecordBatch.from_pylist(ready, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def parses(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation with rows."""
    rows = saved(judged_rows(conversations), "judged-turns")
    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    of_chunks = _chunk_schema(conversations)
    arrow_chunks = _arrow(of_chunks)

    def chunked(batches):
        return _chunks(batches, arrow_chunks)

    chunks = ordered.mapInArrow(chunked, of_chunks)
    fields = [f.name for f in of_chunks.fields if f.name != "conv_id"]
    together = chunks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("chunks")
    )
    result = T.StructType().add("conv_id", conversations.schema["conv_id"].dataType)
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        result = result.add(name, T.LongType())
    result = result.add("audit", T.StringType())
    arrow_result = _arrow(result)

    def parsed(batches):
        return _parsed(batches, arrow_result)

    return together.mapInArrow(parsed, result)


def _edited(rows: Iterable[dict]) -> Iterator[tuple[dict, str, str, str]]:
    """(row, edit, role, text) of every row that stays or is inserted, of rows in order.

    Each conversation begins with a row that has its audit. After the last row of a conversation its
    remaining insertions follow.
    """
    edits: Iterator[tuple[str, str]] = iter(())
    head: dict = {}
    for row in rows:
        if row["audit"] is not None:
            yield from _inserted(head, edits)
            head, edits = row, edited_initials(row["audit"])
            yield row, "", "", ""
            continue
        for edit, initial in edits:
            if edit == "I":
                yield head, edit, ROLES[initial], ""
                continue
            if edit != "D":
                yield row, edit, row["role"] if edit == "K" else ROLES[initial], row["text"]
            break
    yield from _inserted(head, edits)


def _inserted(head: dict, edits: Iterator[tuple[str, str]]) -> Iterator[tuple[dict, str, str, str]]:
    for edit, initial in edits:
        yield head, edit, ROLES[initial], ""


def _in_order(conversations: DataFrame, parsed: DataFrame) -> DataFrame:
    """Audits and texts of each conversation in one task, the audit first, sorted on disk if need be."""
    texts = _rows(conversations).withColumn("audit", F.lit(None).cast("string"))
    heads = parsed.select("conv_id", "audit")
    both = heads.unionByName(texts, allowMissingColumns=True)
    return (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "h1", "h2")
        .select("conv_id", "audit", "turn", "role", "text")
    )


def _all(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


BATCH = 1000


def repaired_rows(conversations: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text, edit, turn (null if inserted)."""
    if parsed is None:
        parsed = saved(parses(conversations), "parses")
    kinds = conversations.schema
    schema = (
        T.StructType()
        .add("conv_id", kinds["conv_id"].dataType)
        .add("place", T.LongType())
        .add("role", T.StringType())
        .add("text", T.StringType())
        .add("edit", T.StringType())
        .add("turn", kinds["turn"].dataType)
    )
    arrow = _arrow(schema)

    def read_out(batches):
        ready, place = [], 0
        for row, edit, role, text in _edited(_all(batches)):
            if not edit:
                place = 0
                continue
            turn = None if edit == "I" else row["turn"]
            values = (row["conv_id"], place, role, text, edit, turn)
            ready.append(dict(zip(arrow.names, values)))
            place += 1
            if len(ready) >= BATCH:
                yield pa.RecordBatch.from_pylist(ready, arrow)
                ready = []
        yield pa.RecordBatch.from_pylist(ready, arrow)

    return _in_order(conversations, parsed).mapInArrow(read_out, schema)


def digests(conversations: DataFrame, parsed: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of the repaired ``role:text`` rows, joined by newlines."""
    schema = (
        T.StructType()
        .add("conv_id", conversations.schema["conv_id"].dataType)
        .add("repaired_sha256", T.StringType())
    )
    arrow = _arrow(schema)

    def hashed(batches):
        ready, digest, conv, begun = [], None, None, False
        for row, edit, role, text in _edited(_all(batches)):
            if not edit:
                if digest is not None:
                    ready.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                digest, conv, begun = hashlib.sha256(), row["conv_id"], False
                if len(ready) >= BATCH:
                    yield pa.RecordBatch.from_pylist(ready, arrow)
                    ready = []
                continue
            digest.update((("\n" if begun else "") + role + ":" + text).encode())
            begun = True
        if digest is not None:
            ready.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(ready, arrow)

    return _in_order(conversations, parsed).mapInArrow(hashed, schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def report(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest for every conversation of ``ids`` (column ``conv_id``)."""
    named = ids.select("conv_id").distinct().withColumn("_id", F.struct("conv_id"))
    parsed = saved(parses(conversations), "parses")
    audits = parsed.withColumn("_id", F.struct("conv_id")).drop("conv_id")
    sums = digests(conversations, parsed).withColumn("_id", F.struct("conv_id")).drop("conv_id")
    found = named.join(audits, "_id", "left").join(sums, "_id", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
