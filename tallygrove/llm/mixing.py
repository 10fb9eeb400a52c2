"""Mixing sources to target weights, in a tree of domain, language and source.

The budget flows down the tree. At each node it is shared among the children by weight, but no child
gets more than all its leaves can give in ``max_epochs`` passes; what a child cannot take goes to its
siblings by their weights. Since a node never gets more than it can give, a shortage stays among
siblings as long as they have tokens and only then reaches the parent's siblings. Shares are whole
numbers of tokens, rounded down, so at each node fewer tokens than it has children stay unspent.

A leaf fills its share with whole epochs and a prefix of one more. In that epoch its rows stand in the
order of a hash seeded by the epoch; the last row is cut to the tokens that are left. Running totals
come from sums over hash ranges, so no task sees a whole leaf.

Tokens are words, maximal runs without blanks. A text without words (null, empty) is never chosen. A
null domain, language or source counts as ``(none)``. Equal rows are different rows of equal standing.
Weights are whole numbers; a weight of 0 leaves a branch out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.llm.tables import packed, row_key, saved

WORD = r"[^\x20\x09-\x0D]+"
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
LEAF = ("_domain", "_lang", "_source")


@dataclass(frozen=True)
class Weights:
    """Weights by name at each level; names that are not given weigh ``otherwise``."""

    domain: Mapping[str, int] = field(default_factory=dict)
    lang: Mapping[str, int] = field(default_factory=dict)
    source: Mapping[str, int] = field(default_factory=dict)
    otherwise: int = 1

    def of(self, level: str, name: Column) -> Column:
        known = getattr(self, level)
        if not known:
            return F.lit(self.otherwise).cast("long")
        table = F.create_map(*(F.lit(x) for pair in sorted(known.items()) for x in pair))
        return F.coalesce(F.try_element_at(table, name), F.lit(self.otherwise)).cast("long")


def source_group(source: str = "source", groups: int = 3) -> Column:
    """A stand-in for a domain where a table has none: by the number that ends the source's name."""
    number = F.regexp_extract(F.col(source), r"(\d{1,9})$", 1)
    group = F.concat(F.lit("group"), F.pmod(number.try_cast("int"), F.lit(groups)).cast("string"))
    return F.when(number != "", group)


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add ``_share``: the parent's ``_budget`` by ``_weight``, within each child's ``_most``.

    Children that can take least for their weight are filled first; the rest goes to the others.
    """
    family = Window.partitionBy(*parent)
    in_order = family.orderBy(F.col("_most") / F.col("_weight"), name)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    some = children.filter((F.col("_weight") > 0) & (F.col("_most") > 0))
    seen = some.select(
        "*",
        F.coalesce(F.sum("_most").over(earlier), F.lit(0)).alias("_given"),
        F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_passed"),
        F.sum("_weight").over(family).alias("_all"),
    )
    # Tokens times weights may be too large for a long.
    tokens = {c: F.col(c).cast("decimal(24,0)") for c in ("_most", "_budget", "_given")}
    weight = {c: F.col(c).cast("decimal(13,0)") for c in ("_all", "_passed", "_weight")}
    full = seen.withColumn(
        "_full",
        tokens["_most"] * (weight["_all"] - weight["_passed"])
        <= (tokens["_budget"] - tokens["_given"]) * weight["_weight"],
    )
    filled = full.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("_full"), F.col("_most"))).over(family), F.lit(0)).alias("_used"),
        F.coalesce(F.sum(F.when(F.col("_full"), F.col("_weight"))).over(family), F.lit(0)).alias("_done"),
    )
    rest = F.expr(
        "cast(_budget - _used as decimal(24,0)) * cast(_weight as decimal(13,0)) "
        "div nullif(cast(_all - _done as decimal(13,0)), 0)"
    )
    share = F.when(F.col("_full"), F.col("_most")).otherwise(rest)
    return filled.select(*children.columns, share.alias("_share"))


def leaf_budgets(rows: DataFrame, share: float, weights: Weights, max_epochs: int) -> DataFrame:
    """One row per leaf: its names, tokens and share, from rows with ``LEAF`` and ``_tokens``."""
    leaves = rows.groupBy(*LEAF).agg(F.sum("_tokens").alias("_total"))
    leaves = leaves.withColumn("_most", F.col("_total") * max_epochs)
    langs = leaves.groupBy("_domain", "_lang").agg(
        F.sum("_most").alias("_most"), F.sum("_total").alias("_total")
    )
    domains = langs.groupBy("_domain").agg(
        F.sum("_most").alias("_most"), F.sum("_total").alias("_total")
    )
    # A handful of rows: one per domain.
    everything = Window.partitionBy(F.lit(0))
    asked = F.floor(F.lit(share) * F.sum("_total").over(everything)).cast("long")
    domains = domains.select(
        "_domain",
        "_most",
        F.least(asked, F.sum("_most").over(everything)).alias("_budget"),
        weights.of("domain", F.col("_domain")).alias("_weight"),
        F.lit(0).alias("_root"),
    )
    by_domain = share_out(domains, ["_root"], "_domain").select(
        "_domain", F.col("_share").alias("_budget")
    )
    langs = langs.join(by_domain, "_domain").withColumn(
        "_weight", weights.of("lang", F.col("_lang"))
    )
    by_lang = share_out(langs, ["_domain"], "_lang").select(
        "_domain", "_lang", F.col("_share").alias("_budget")
    )
    leaves = leaves.join(by_lang, ["_domain", "_lang"]).withColumn(
        "_weight", weights.of("source", F.col("_source"))
    )
    return share_out(leaves, ["_domain", "_lang"], "_source").select(*LEAF, "_total", "_share")


def _started(rows: DataFrame) -> DataFrame:
    """Add ``_start``: tokens of the leaf that come before the row in the order of ``_hash``.

    Totals run over 256 ranges of the hash per leaf, then 4,096 within a range, then over the rows of
    such a range.
    """
    rows = rows.select(
        "*",
        F.shiftrightunsigned("_hash", 56).alias("_high"),
        F.shiftrightunsigned("_hash", 44).bitwiseAND(F.lit(4095)).alias("_low"),
    )

    def before(window):
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_tokens").over(earlier), F.lit(0))

    fine = rows.groupBy(*LEAF, "_high", "_low").agg(F.sum("_tokens").alias("_tokens"))
    coarse = fine.groupBy(*LEAF, "_high").agg(F.sum("_tokens").alias("_tokens"))
    coarse = coarse.select(
        *LEAF, "_high", before(Window.partitionBy(*LEAF).orderBy("_high")).alias("_first")
    )
    fine = fine.select(
        *LEAF,
        "_high",
        "_low",
        before(Window.partitionBy(*LEAF, "_high").orderBy("_low")).alias("_second"),
    ).join(coarse, [*LEAF, "_high"])
    within = Window.partitionBy(*LEAF, "_high", "_low").orderBy("_hash", "_key1", "_key2")
    placed = rows.withColumn("_third", before(within))
    return placed.join(fine, [*LEAF, "_high", "_low"]).withColumn(
        "_start", F.col("_first") + F.col("_second") + F.col("_third")
    )


def selection(
    documents: DataFrame,
    share: float,
    weights: Weights,
    max_epochs: int = 1,
    seed: int = 42,
    domain: Column | None = None,
) -> DataFrame:
    """One row per chosen document and epoch: key, leaf, ``epoch``, ``n_tokens``, ``taken_tokens``.

    ``share`` is the budget as a part of all tokens of the table.
    """
    none = F.lit("(none)")
    rows = documents.select(
        "doc_id",
        F.coalesce(source_group() if domain is None else domain, none).alias("_domain"),
        F.coalesce("lang", none).alias("_lang"),
        F.coalesce("source", none).alias("_source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("_tokens"),
        *row_key(documents),
    )
    # Texts are read once; everything after works on these short rows.
    rows = saved(rows.filter("_tokens > 0"), "mixing-rows")
    leaves = saved(leaf_budgets(rows, share, weights, max_epochs), "mixing-leaves")
    whole, rest = F.expr("_share div _total"), F.expr("_share % _total")
    drawn = rows.join(leaves.withColumns({"_whole": whole, "_rest": rest}), list(LEAF))
    drawn = drawn.withColumn(
        "_hash", F.xxhash64(F.lit(seed), "_whole", F.col("_key1"), F.col("_key2"))
    )
    started = _started(drawn)
    entry = "named_struct('epoch', {}, 'taken_tokens', {})"
    epochs = F.expr(
        "concat("
        "if(_whole > 0, transform(sequence(0L, greatest(_whole - 1, 0L)), e -> "
        + entry.format("e", "_tokens")
        + "), array()), "
        "if(_start < _rest, array("
        + entry.format("_whole", "least(_tokens, _rest - _start)")
        + "), array()))"
    )
    return started.select(
        "_key1",
        "_key2",
        "doc_id",
        F.col("_domain").alias("domain"),
        F.col("_lang").alias("lang"),
        F.col("_source").alias("source"),
        F.col("_tokens").alias("n_tokens"),
        F.inline(epochs),
    )


def mixed(documents: DataFrame, share: float, weights: Weights, **options) -> DataFrame:
    """The chosen documents with their own columns, once per epoch; a cut document has its prefix."""
    columns = documents.columns
    chosen = selection(documents, share, weights, **options).select(
        "_key1", "_key2", F.col("n_tokens").alias("_has"), F.col("taken_tokens").alias("_taken")
    )
    # Equal rows are one row here and as many as were chosen after the join.
    distinct = packed(documents, *row_key(documents)).dropDuplicates(["_key1", "_key2"])
    joined = distinct.join(chosen, ["_key1", "_key2"])
    cut = F.col("_taken") < F.col("_has")
    words = F.slice(F.split("_row.text", WORD_END), F.lit(1), F.col("_taken").cast("int"))
    joined = joined.withColumn(
        "_text", F.when(cut, F.array_join(words, "")).otherwise(F.col("_row.text"))
    )
    own = {"text": F.col("_text")}
    if "n_chars" in columns:
        shorter = F.length("_text").cast(documents.schema["n_chars"].dataType)
        own["n_chars"] = F.when(cut, shorter).otherwise(F.col("_row.n_chars"))
    return joined.select(*(own.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns))
