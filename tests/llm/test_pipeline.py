"""The pipeline's stages, each on what the one before it kept."""

from collections import Counter

import rows as R

import corpus_pipeline as P
from tallygrove.llm import queries
from tallygrove.llm.tables import saved

MEDIUM = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    kept = [docs]
    for _, stage in P.STAGES:
        kept.append(saved(stage(spark, kept[-1], MEDIUM), "stage"))
    start, good, single, clean, mixed, shards = kept
    for table in (good, single, clean, mixed):
        assert table.columns == docs.columns

    def ids(table):
        return Counter(r["doc_id"] for r in table.select("doc_id").collect())

    judged = {r["doc_id"] for r in queries.op1_quality_rules(spark, MEDIUM).filter("kept").collect()}
    assert ids(good) == Counter(judged)

    from tallygrove.llm.simhash import near_duplicates

    groups = {r["component_id"] for r in near_duplicates(good).collect()}
    assert ids(single) == Counter(groups)
    leaks = {r["doc_id"] for r in queries.op7_decontaminate(spark, MEDIUM).collect()}
    assert ids(clean) == Counter(i for i in groups if i not in leaks)
    assert set(ids(mixed)) <= set(ids(clean)) and max(ids(mixed).values()) == 1
    words = "sum(size(regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0))) AS n"
    before, after = (t.selectExpr(words).first()["n"] for t in (clean, mixed))
    assert 0.9 * before - 100 <= after <= 0.9 * before
    assert all(r["bytes"] == r["sequences"] * 2048 for r in shards.collect())
    assert P.run(spark, MEDIUM).orderBy("shard").collect() == shards.orderBy("shard").collect()


def test_awkward_and_empty_tables(spark, tmp_path):
    for name, docs in (("awkward", R.awkward(spark)), ("empty", R.empty(spark))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        R.labels(spark, [(i, i % 2, 0, None) for i in range(10)]).write.parquet(f"{folder}/labels.parquet")
        R.benchmark(spark, [(1, R.TEXTS[4], None)]).write.parquet(f"{folder}/benchmark.parquet")
        assert P.run(spark, folder).columns == ["shard", "sequences", "bytes", "checksum"]
