"""URL rules and the listed URLs behind the Bloom filter, against a plain version."""

import re
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from tallygrove.llm import queries, url_filter
from tallygrove.llm.url_filter import ALLOW, BLOCK, Rule

MEDIUM = "/root/testdata/sf0.01"
UPPER = {i: i + 32 for i in range(65, 91)}
AWKWARD = [
    None,
    "",
    "no scheme here",
    "://",
    "http://",
    "http://EXAMPLE.com",
    "http://example.com/en/",
    "http://www.example.com/en/x",
    "http://notexample.com/en/x",
    "http://a.b.example.com/en/x?u=http://example.org/de/",
    "https://shop.net/es/1",
    "https://net/fr/",
    "https://net/fr",
    "https://user:pw@Spam.example.org:443//a//b/index.html?b=2&utm_source=x&a=1&&ref=z#frag",
    "http://www.spam.example.org/a/b?a=1&b=2",
    "http://spam.example.org/a/b?b=2&a=1#",
    "http://spam.example.org/a/b?b=3&a=1",
    "http://spam.example.org./a/b/?a=1&b=2",
    "http://ÄÖ.example.org/\nx",
    "http://long.example.org/" + "a/" * 200_000,
    "first http://x.example.org/1 http://y.example.org/2",
]


def split(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    host = host.translate(UPPER)
    name = re.sub("^[^@]*@", "", host)
    name = re.sub(r"\.$", "", re.sub(r"^www\.", "", re.sub(r":(80|443)?$", "", name)))
    short = re.sub(r"/$", "", re.sub(r"/index\.html?$", "/", re.sub("/+", "/", path)))
    query = re.match(r"[^?#]*(?:\?([^#]*))?", rest).group(1) or ""
    more = sorted(
        p for p in query.split("&") if p and not re.match(url_filter.TRACKING, p)
    )
    return host, path, name + short + ("?" + "&".join(more) if more else "")


def naive(urls, listed, rules=url_filter.RULES):
    known = {split(u)[2] for u in listed} - {None}
    out = []
    for url in urls:
        host, path, address = split(url)
        fits = [
            r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        ]
        best = min(fits, key=lambda r: (-len(r.name), r.name, r.host), default=None)
        on_list = address in known
        verdict = best.verdict if best else BLOCK if on_list else ALLOW
        out.append((host, path, address, best.name if best else None, on_list, verdict))
    return out


def table(spark, urls):
    rows = [(i, u, "a", 1, None) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id LONG, url STRING, _url STRING, _maybe INT, `a.b` STRING")


def judged(df, listed, **more):
    out = url_filter.judged(df, listed, **more)
    rows = out.select("page_id", F.col(out.columns[-1]).alias("v")).orderBy("page_id").collect()
    return out, [tuple(r["v"]) for r in rows]


def test_split_agrees_with_the_standard_library():
    for url in ("http://a.B.c/d/e?f#g", "https://x.org?y/z", "http://u@h:81/p#/q"):
        assert split(url)[:2] == (urlsplit(url).netloc.lower(), urlsplit(url).path)


@pytest.mark.parametrize("most_blocks", [1, 1 << 20])
def test_awkward_urls(spark, most_blocks):
    listed = ["http://spam.example.org/a/b?a=1&b=2", None, "nothing", "https://www.Spam.example.org/a/b/?b=2&a=1"]
    urls = AWKWARD + AWKWARD[5:9]
    df = table(spark, urls)
    known = url_filter.url_list(table(spark, listed), most_blocks=most_blocks)
    assert known.urls.count() == 1
    out, got = judged(df, known)
    assert out.columns == [*df.columns, "_url_"]
    assert out.drop("_url_").exceptAll(df).count() == 0
    assert got == naive(urls, listed)
    assert sum(v[4] for v in got) == 4
    kept = url_filter.allowed(df, known)
    assert kept.columns == df.columns
    assert kept.count() == sum(v[5] == ALLOW for v in got)


def test_full_filter_changes_nothing(spark):
    """A filter of one block passes every address; the exact join still decides."""
    urls = [f"http://host{i % 50}.example.org/{i}" for i in range(3000)]
    known = url_filter.url_list(table(spark, urls[:2000:2]), most_blocks=1)
    tried = known.may_hold(table(spark, urls).withColumn("_address", url_filter.canonical(F.col("url"))).drop("_maybe"), "_address")
    assert tried.filter("_maybe").count() > 2900
    assert judged(table(spark, urls), known)[1] == naive(urls, urls[:2000:2])


def test_filter_is_selective_and_loses_nothing(spark):
    urls = [f"http://host{i % 50}.example.org/{i}" for i in range(20_000)]
    known = url_filter.url_list(table(spark, urls[:10_000]))
    assert known.n_blocks == 512
    assert known.blocks.count() <= 512
    df = table(spark, urls).withColumn("_address", url_filter.canonical(F.col("url"))).drop("_maybe")
    tried = known.may_hold(df, "_address").select("page_id", "_maybe").collect()
    assert all(r["_maybe"] for r in tried if r["page_id"] < 10_000)
    assert sum(r["_maybe"] for r in tried if r["page_id"] >= 10_000) < 300


def test_no_list_and_no_pages(spark):
    none = url_filter.url_list(table(spark, []))
    assert judged(table(spark, AWKWARD), none)[1] == naive(AWKWARD, [])
    some = url_filter.url_list(table(spark, AWKWARD))
    assert judged(table(spark, []), some)[1] == []


def test_rules(spark):
    rules = [Rule("org", "/", BLOCK), Rule("a.org", "", ALLOW), Rule("b.org", "/x", ALLOW), Rule("b.org", "/x", ALLOW)]
    urls = ["http://a.org", "http://a.org/x", "http://c.a.org/", "http://b.org/xy", "http://b.org/z", "http://ba.org/"]
    none = url_filter.url_list(table(spark, []))
    assert judged(table(spark, urls), none, rules=rules)[1] == naive(urls, [], rules)
    with pytest.raises(ValueError):
        url_filter.judged(table(spark, urls), none, [*rules, Rule("org", "/", ALLOW)])
    with pytest.raises(ValueError):
        url_filter.judged(table(spark, urls), none, [Rule(f"h{i}", "/", BLOCK) for i in range(1001)])


def test_query(spark):
    rows = spark.read.parquet(f"{MEDIUM}/pages.parquet").select("page_id", "url").collect()
    urls = {r["page_id"]: r["url"] for r in rows}
    listed = [u for u in urls.values() if re.search(queries.SPAM_HOSTS, split(u)[0])]
    want = dict(zip(urls, naive(urls.values(), listed)))
    got = queries.op12_url_filter(spark, MEDIUM)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "canonical", "listed"]
    assert {
        r["page_id"]: (r["host"], r["path"], r["canonical"], r["rule"], r["listed"], r["verdict"]) for r in got.collect()
    } == want
    assert any(v[4] and v[3] is None for v in want.values())


def test_native_plan(spark):
    plan = queries.op12_url_filter(spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions|Cartesian|NestedLoop", plan)
    assert "ShuffledHashJoin" in plan
