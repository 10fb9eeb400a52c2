"""From documents to token shards: every stage calls one operator of ``tallygrove.llm``.

Quality rules remove what they reject, of each group of near-duplicates the document with the smallest
id stays, documents that hold a benchmark item go, sources are mixed to the target weights (one epoch
at most, so no document comes twice) and the rest is written as token shards. Every stage's rows are
written as Parquet and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallygrove.llm import decontaminate, mixing, quality_rules, simhash, token_shards
from tallygrove.llm.queries import TARGET
from tallygrove.llm.tables import saved
from tallygrove.sources.scratch import scratch_path

# No SQL can train the model of the first stage; tests compare the others with brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality_rules.train_quality(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, by the target weights."""
    return mixing.mixed(docs, 0.9, TARGET)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per shard that was written: its number, sequences, bytes and checksum."""
    return token_shards.write_shards(docs, scratch_path(spark, "pipeline-shards")).manifest


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mixing_stage),
    ("token shards", shard_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
