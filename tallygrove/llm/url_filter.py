"""URL filters: host and path rules, then a list of URLs behind a blocked Bloom filter.

DataFrame functions only. A URL is split into host and path; the longest rule that fits decides. Where
none does, the URL is blocked if its canonical form is listed. Listed URLs are hashed into a Bloom
filter of blocks of 256 bits: one hash chooses the block, another sets two bits in each of its four
words. A page reads one block, so the test is one lookup. Pages that miss a bit are surely not listed
and pass without a shuffle; only possible hits go to the exact hash join with the list, which removes
the false positives. The result therefore never depends on the size of the filter.

The filter's blocks are broadcast: there are at most ``MOST_BLOCKS`` of them (32 MB of bits). A list
beyond about 22 million URLs fills them more densely, so more pages reach the exact join; nothing is
lost. The list itself is never broadcast. One URL with very many pages is a hot key of the join's page
side only, which Spark splits at run time, since the list holds each canonical URL once.

Canonical form: without scheme, user, ``www.``, port 80 or 443 and the host's last dot; A-Z of the host
lower-cased; repeated slashes of the path are one, ``index.html`` and last slashes go; no fragment;
parameters that only track visitors are dropped and the others sorted.

A null URL or one without ``://`` has an empty host and path, no canonical form, fits no rule and is
never listed. URLs are handled whole, whatever their length. Of rules of equal length the first in
alphabetical order wins; a rule given twice with both verdicts is an error. Repeated rows are judged
each. Columns of any name stay: if the result's name is taken, underscores are added to it. An empty
table gives an empty result, an empty list blocks nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.license_scan import LOWER, UPPER
from tallygrove.llm.tables import free_name, packed, saved

ALLOW, BLOCK = "allow", "block"
# Bits of the filter per listed URL, bits of a block, and the bound on what is broadcast.
URL_BITS, BLOCK_BITS, MOST_BLOCKS = 12, 256, 1 << 20
WORDS, WORD_MARKS = 4, 2
# Rules become part of the plan, so they are few.
MOST_RULES = 1000
# Parameters that name a campaign or a click.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|msclkid|mc_cid|mc_eid)(=|$)"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules that the registered query is about.
RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)


def _after_scheme(url: Column) -> Column:
    found = F.locate("://", url)
    return F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands after the first ``://``, up to ``/``, ``?`` or ``#``, with A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One form for the spellings of an address; null where there is no ``://``."""
    name = F.regexp_replace(host_of(url), "^[^@]*@", "")
    name = F.regexp_replace(name, ":(80|443)?$", "")
    name = F.regexp_replace(F.regexp_replace(name, r"^www\.", ""), r"\.$", "")
    path = F.regexp_replace(path_of(url), "/+", "/")
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", "/"), "/$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    more = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&")))
    whole = F.concat(name, path, F.coalesce(more, F.lit("")))
    return F.when(F.locate("://", url) > 0, whole)


def _marks(address: Column) -> list[Column]:
    """The bits that an address sets in each word of its block."""
    h = F.xxhash64(F.lit(1), address)

    def bit(i: int) -> Column:
        # A literal of the right type: shifting a plain 1 would be done in 32 bits.
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [
        reduce(lambda a, b: a.bitwiseOR(b), (bit(WORD_MARKS * w + k) for k in range(WORD_MARKS)))
        for w in range(WORDS)
    ]


def _block(address: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), address), F.lit(n_blocks)).cast("int")


@dataclass(frozen=True)
class UrlList:
    """Canonical URLs, each once (column ``_listed``), and the filter's blocks."""

    urls: DataFrame
    blocks: DataFrame
    n_blocks: int

    def may_hold(self, df: DataFrame, address: str) -> DataFrame:
        """Add ``_maybe``: false only where the address is surely not listed."""
        tried = df.withColumn("_block", _block(F.col(address), self.n_blocks))
        fits = reduce(
            lambda a, b: a & b,
            (F.col(f"_word{w}").bitwiseAND(m) == m for w, m in enumerate(_marks(F.col(address)))),
        )
        found = tried.join(F.broadcast(self.blocks), "_block", "left")
        words = (f"_word{w}" for w in range(WORDS))
        return found.withColumn("_maybe", F.coalesce(fits, F.lit(False))).drop("_block", *words)


def url_list(urls: DataFrame, column: str = "url", most_blocks: int = MOST_BLOCKS) -> UrlList:
    """A list of the URLs in ``column``; spellings of one address count once."""
    address = canonical(F.col(f"`{column}`")).alias("_listed")
    kept = saved(urls.select(address).filter(F.col("_listed").isNotNull()).distinct(), "listed-urls")
    needed = kept.count() * URL_BITS / BLOCK_BITS
    n_blocks = min(most_blocks, 1 << max(0, math.ceil(math.log2(max(needed, 1)))))
    marked = kept.select(
        _block(F.col("_listed"), n_blocks).alias("_block"),
        *(m.alias(f"_word{w}") for w, m in enumerate(_marks(F.col("_listed")))),
    )
    words = (F.bit_or(f"_word{w}").alias(f"_word{w}") for w in range(WORDS))
    return UrlList(kept, saved(marked.groupBy("_block").agg(*words), "bloom-blocks"), n_blocks)


def _ordered(rules: Sequence[Rule]) -> list[Rule]:
    distinct = sorted(set(rules), key=lambda r: (-len(r.name), r.name, r.host))
    if len(distinct) > MOST_RULES:
        raise ValueError(f"{len(distinct)} rules, at most {MOST_RULES}: list single URLs instead")
    if len({(r.host, r.path) for r in distinct}) < len(distinct):
        raise ValueError("a rule has two verdicts")
    return distinct


def judged(
    pages: DataFrame,
    listed: UrlList,
    rules: Sequence[Rule] = RULES,
    column: str = "url",
    into: str = "_url",
) -> DataFrame:
    """All columns and a struct: host, path, canonical, rule, listed, verdict."""
    url = F.col(f"`{column}`")
    into = free_name(into, pages.columns)
    parts = packed(
        pages, host_of(url).alias("_host"), path_of(url).alias("_path"), canonical(url).alias("_address")
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(_ordered(rules)):
        own = (F.col("_host") == r.host) | F.endswith(F.col("_host"), F.lit("." + r.host))
        fits = own & F.startswith(F.col("_path"), F.lit(r.path))
        rule = F.when(fits, F.lit(r.name)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    tried = listed.may_hold(parts, "_address")
    passed = tried.filter(~F.col("_maybe")).withColumn("_is_listed", F.lit(False))
    exact = listed.urls.hint("shuffle_hash")
    hits = (
        tried.filter("_maybe")
        .join(exact, F.col("_address") == F.col("_listed"), "left")
        .withColumn("_is_listed", F.col("_listed").isNotNull())
        .drop("_listed")
    )
    by_list = F.when(F.col("_is_listed"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    result = F.struct(
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_address").alias("canonical"),
        rule.alias("rule"),
        F.col("_is_listed").alias("listed"),
        F.coalesce(verdict, by_list).alias("verdict"),
    )
    return passed.unionByName(hits).select("_row.*", result.alias(into))


def allowed(
    pages: DataFrame, listed: UrlList, rules: Sequence[Rule] = RULES, column: str = "url"
) -> DataFrame:
    """The pages that are not blocked, with their own columns."""
    into = free_name("_url", pages.columns)
    kept = judged(pages, listed, rules, column, into).filter(F.col(f"`{into}`")["verdict"] == ALLOW)
    return kept.drop(into)
