"""A classification table built from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.plans.spec import TableSpec

# The order table's roles, marker and label threshold.
REVENUE_CUT = 200_000
ORDER_SPEC = TableSpec(
    key=("o_orderkey",),
    categorical=("o_orderstatus", "o_orderpriority", "c_mktsegment"),
    numeric=("n_lines", "sum_qty"),
    label_source="revenue_band",
    positive_marker=">200K",
    sentinel_columns=("o_orderstatus",),
    sentinel="P",
    dropped=("c_acctbal",),
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its status, priority, customer segment, line totals and revenue band.

    Lines are summed per order before the join, so the join is one row to one row.
    """
    lines = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").cast("int").alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        )
    )
    orders = load(spark, sf_dir, "orders")
    customers = load(spark, sf_dir, "customer")
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            "o_orderstatus",
            "o_orderpriority",
            "c_mktsegment",
            "n_lines",
            "sum_qty",
            "c_acctbal",
            F.when(F.col("revenue") > REVENUE_CUT, ">200K").otherwise("<=200K")
            .alias("revenue_band"),
        )
    )
