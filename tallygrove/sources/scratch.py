"""A folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the session's ``spark.checkpoint.dir``, or else below its warehouse.

    Both are folders that driver and executors share. Where the first is unset and the warehouse is a
    folder of the machine, as it is by default, a cluster's executors would each write to a disk of their
    own and rows would be lost, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if _is_local_folder(warehouse) and not _runs_in_one_process(spark.conf.get("spark.master", "local")):
            raise ValueError(
                f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} is local"
            )
        root = warehouse.rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _is_local_folder(path: str) -> bool:
    return path.startswith("file:")


def _runs_in_one_process(master: str) -> bool:
    """``local`` and ``local[n]``, but not ``local-cluster``, whose executors are processes of their own."""
    return master == "local" or master.startswith("local[")


def saved_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new scratch path and read back, so that its size is known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
