"""Delimited and parquet tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType


def read_table(
    source: SparkSession | DataStreamReader,
    path: str,
    schema: str | StructType,
    header: bool = False,
    sep: str = ",",
) -> DataFrame:
    """Delimited text with an explicit schema, of a session or a stream. Blanks around values are data."""
    reader = source.read if isinstance(source, SparkSession) else source
    return (
        reader.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


# A scored table is a folder of versions, each written whole, and below ``PUBLISHED`` a small table that says
# which one is valid.
PUBLISHED = "published"
POINTER = "folder STRING, version LONG"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, folder) of everything published at ``path``, oldest first; one small file each."""
    try:
        rows = spark.read.schema(POINTER).parquet(f"{path.rstrip('/')}/{PUBLISHED}").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r["version"], r["folder"]) for r in rows)


def write_scores(df: DataFrame, path: str) -> None:
    """Replace the parquet table at ``path`` with the scored rows, without a gap.

    The rows go to a folder of their own. Only when all of them are there, a pointer of one row is
    committed, by the rename of one file; until then readers see the scores of before, and a job that is
    killed leaves them as they were. Older versions stay until ``drop_old_scores``.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"scores-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    known = _versions(spark, path)
    pointer = spark.createDataFrame([(folder, known[-1][0] + 1 if known else 1)], POINTER)
    pointer.coalesce(1).write.mode("append").partitionBy("version").parquet(f"{path}/{PUBLISHED}")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """The scores that were published last, or a plain parquet table where none were."""
    known = _versions(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/{known[-1][1]}" if known else path)


def drop_old_scores(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` published versions; how many went.

    Two by default, so that a reader which began before the last publication can finish. Folders of jobs
    that were killed before they published stay, as they may belong to one that is still writing.
    """
    if keep < 1:
        raise ValueError("the last version has to stay")
    old = _versions(spark, path)[:-keep]
    for version, folder in old:
        for part in (f"{PUBLISHED}/version={version}", folder):
            target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{part}")
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(old)
