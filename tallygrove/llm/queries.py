"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
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
    spelling,
    token_shards,
    turn_repair,
    url_filter,
)
from tallygrove.llm.text import crc_remainder
from tallygrove.sources.scratch import scratch_path

TARGET = mixing.Weights(
    domain={"group0": 5, "group1": 3, "group2": 2},
    lang={"en": 4, "de": 2, "fr": 2, "es": 1},
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality_rules.train_quality(documents, _table(spark, sf_dir, "labels"))
    q = "_quality"
    return quality_rules.judged(documents.select("doc_id", "text"), model).select(
        "doc_id",
        *(f"{q}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")),
        *(f"{q}.{c}" for c in ("n_repeat_words", "base_failed", "kept", "probability", "tier")),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return license_scan.scanned(documents).select("doc_id", *(f"_licence.{c}" for c in kept))


def op3_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = html_render.rendered(pages.select("page_id", "html"))
    return found.select("page_id", "text", F.length("text").alias("n_chars"))


def op4_line_chain_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 4) == 2
    labels = _table(spark, sf_dir, "labels").filter(~held_out)
    model = line_crf.fit_line_chain(documents, labels)
    scored = line_crf.scored(documents.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 3) == 1
    model = language_id.train_languages(documents.filter(~held_out))
    found = language_id.identified(documents.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "_lang.*")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return decontaminate.contaminated(documents, _table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return mixing.selection(documents, 0.8, TARGET, max_epochs=3).drop("_key1", "_key2")


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    shards = token_shards.write_shards(documents, scratch_path(spark, "token-shards"))
    read = token_shards.read_shards(spark, shards)
    return read.select("slot", "shard", "place", "sequence", F.crc32("tokens").alias("checksum"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_table(spark, sf_dir, "documents"), slips=199))


# Labels of hosts that ad and spam lists name. Their pages' addresses are the list.
SPAM_HOSTS = r"(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\."


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    listed = url_filter.url_list(pages.filter(url_filter.host_of(F.col("url")).rlike(SPAM_HOSTS)))
    kept = ("host", "path", "rule", "verdict", "canonical", "listed")
    return url_filter.judged(pages, listed).select("page_id", *(f"_url.{c}" for c in kept))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return turn_repair.report(turn_repair.damaged(conversations), conversations)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_license_scan,
        op3_html_render,
        op4_line_chain_quality,
        op5_line_dedup,
        op6_language_id,
        op7_decontaminate,
        op8_mixing,
        op9_token_shards,
        op10_simhash,
        op11_spelling_variants,
        op12_url_filter,
        op13_turn_repair,
    )
}
