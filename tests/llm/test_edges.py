"""Nulls, empty and very long texts, repeated rows, empty tables and clashing names."""

import pytest
import rows as R
from pyspark.sql import functions as F

from tallygrove.llm import (
    decontaminate,
    html_render,
    language_id,
    license_scan,
    line_crf,
    line_dedup,
    mixing,
    quality_rules,
    simhash,
    token_shards,
)
from tallygrove.llm.tables import row_key, saved

LABELS = [(i, i % 2, 0, None) for i in range(10)] + [(None, 1, 0, None), (3, None, 0, None)]
TARGET = mixing.Weights()
ITEMS = [(1, R.TEXTS[4], None), (2, None, None), (3, "", None), (4, "Only one sentence", None)]


def shard_rows(spark, docs):
    from tallygrove.sources.scratch import scratch_path

    shards = token_shards.write_shards(saved(docs, "t"), scratch_path(spark, "shards"), 64, 8)
    return token_shards.read_shards(spark, shards)


OPERATORS = {
    "quality": lambda s, d: quality_rules.judged(
        d, quality_rules.train_quality(d, R.labels(s, LABELS)), into="_q"
    ),
    "quality_kept": lambda s, d: quality_rules.kept_documents(
        d, quality_rules.train_quality(d, R.labels(s, LABELS))
    ),
    "licence": lambda s, d: license_scan.scanned(d),
    "html": lambda s, d: html_render.rendered(d, "text", "shown"),
    "lines": lambda s, d: line_crf.scored(d, line_crf.fit_line_chain(d, R.labels(s, LABELS))),
    "dedup": lambda s, d: line_dedup.without_near_lines(d),
    "dedup_report": lambda s, d: line_dedup.line_report(d),
    "language": lambda s, d: language_id.identified(d, language_id.train_languages(d)),
    "leaks": lambda s, d: decontaminate.contaminated(d, R.benchmark(s, ITEMS)),
    "clean": lambda s, d: decontaminate.clean(d, R.benchmark(s, ITEMS)),
    "mixing": lambda s, d: mixing.mixed(d, 0.7, TARGET, max_epochs=2),
    "shards": shard_rows,
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "one_of_each": lambda s, d: simhash.one_of_each(d),
}
SAME_ROWS = {"quality": 0, "licence": 0, "html": 0, "lines": 0, "language": 0, "simhash": 0}
SAME_COLUMNS = ("quality_kept", "clean", "mixing", "one_of_each")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows(spark, name):
    docs = R.awkward(spark)
    out = OPERATORS[name](spark, docs)
    found = out.collect()
    if name in SAME_ROWS:
        assert len(found) == docs.count()
    if name in SAME_COLUMNS:
        assert out.columns == docs.columns


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, R.empty(spark)).collect() == []


def test_nothing_to_learn_from(spark):
    docs, none = R.awkward(spark), R.labels(spark)
    model = quality_rules.train_quality(docs, none)
    assert quality_rules.judged(docs, model, into="_q").filter("_q.tier <> 'good'").count() == 0
    chain = line_crf.fit_line_chain(docs, none)
    assert line_crf.scored(docs, chain, "_s").filter("_s < 0.99").count() == 0
    languages = language_id.train_languages(docs.filter("false"))
    assert {r[0] for r in language_id.identified(docs, languages).select("_lang.lang_pred").collect()} == {"und"}


def test_no_benchmark(spark):
    docs = R.awkward(spark)
    assert decontaminate.contaminated(docs, R.benchmark(spark)).count() == 0
    assert decontaminate.clean(docs, R.benchmark(spark)).count() == docs.count()


def test_defined_results(spark):
    docs = R.awkward(spark)
    kept = simhash.one_of_each(docs).collect()
    # Null, empty and blank texts share fingerprint zero; the repeated row and its copy share another.
    ids = [r["doc_id"] for r in kept]
    assert 0 in ids and 1 not in ids and 2 not in ids and 4 in ids and 5 not in ids
    assert ids.count(4) == 1
    licences = {r["doc_id"]: r for r in license_scan.scanned(docs).select("doc_id", "_licence.*").collect()}
    assert licences[4]["labels"] == "mit" and licences[4]["first_word"] == 5
    assert licences[0]["n_words"] == 0 and licences[0]["labels"] == "" and licences[0]["score"] == 0.0
    leaks = {(r["doc_id"], r["item_id"]) for r in OPERATORS["leaks"](spark, docs).collect()}
    assert leaks == {(4, 1), (5, 1)}
    report = {r["doc_id"]: r for r in line_dedup.line_report(docs).collect()}
    assert report[9]["dropped"] == [2] and report[9]["n_lines"] == 6
    assert report[5]["n_kept"] == 0 and report[4]["n_kept"] == 1
    assert report[0]["n_lines"] == 0


def with_maps(docs):
    """A map, a map inside a struct and a list, and one whose entries come in either order."""
    either = F.when(
        F.col("doc_id") % 2 == 0, F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    ).otherwise(F.create_map(F.lit("b"), F.lit(2), F.lit("a"), F.lit(1)))
    nested = F.array(F.struct(either.alias("inner"), F.lit(None).cast("int").alias("n")))
    return docs.withColumns({"map": either, "nested": nested, "none": F.lit(None).cast("map<string,int>")})


@pytest.mark.parametrize("name", ["dedup", "dedup_report", "mixing", "one_of_each"])
def test_map_columns(spark, name):
    docs = R.awkward(spark)
    plain, mapped = OPERATORS[name](spark, docs), OPERATORS[name](spark, with_maps(docs))
    if name in SAME_COLUMNS:
        assert mapped.columns == with_maps(docs).columns
    assert sorted(str(r["doc_id"]) for r in mapped.collect()) == sorted(str(r["doc_id"]) for r in plain.collect())


def test_maps_with_equal_entries_have_equal_keys(spark):
    one = with_maps(spark.createDataFrame([(1,), (2,)], "doc_id INT")).select("map", "nested", "none")
    assert one.select(*row_key(one)).distinct().count() == 1
    other = one.withColumn("map", F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(3)))
    assert one.union(other).select(*row_key(one)).distinct().count() == 2


def test_licence_scan_keeps_columns_of_its_working_names(spark):
    clashing = {c: F.lit(f"own {c}") for c in ("_words", "_codes", "_found", "_base", "_Base_")}
    docs = R.awkward(spark)
    out = license_scan.scanned(docs.withColumns(clashing)).collect()
    plain = {str(r["_licence"]) for r in license_scan.scanned(docs).collect()}
    assert {str(r["_licence"]) for r in out} == plain
    assert all(r[c] == f"own {c}" for r in out for c in clashing)
