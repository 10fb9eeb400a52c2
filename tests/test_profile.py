import math
import random

import pytest
from pyspark.sql import functions as F

from tallygrove.operators import profile


def test_schema_table(spark):
    df = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    rows = [tuple(r) for r in profile.schema_table(df).collect()]
    assert rows == [(0, "a", "int", True), (1, "b", "string", True)]


def test_preview_is_the_first_by_key(spark):
    df = spark.createDataFrame([(i,) for i in range(100, 0, -1)], "k INT").repartition(7)
    assert [r["k"] for r in profile.preview(df, 3, ["k"]).collect()] == [1, 2, 3]


def test_describe_handles_empty_columns(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a")], "x DOUBLE, t STRING")
    rows = {r["column"]: r for r in profile.describe_table(df).collect()}
    assert rows["x"]["n"] == 0 and rows["x"]["mean"] is None
    assert (rows["t"]["min_text"], rows["t"]["max_text"]) == ("a", "b")


@pytest.mark.parametrize("accuracy, near", [(20, 10), (20, 100_000), (10_000, 100_000)])
def test_exact_quantiles_against_sorting(spark, monkeypatch, accuracy, near):
    monkeypatch.setattr(profile, "NEAR_ROWS", near)
    draw = random.Random(5)
    values = [draw.choice([7.0, draw.uniform(-50, 50), None]) for _ in range(3000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x DOUBLE, k INT")
    table = {r["column"]: r for r in profile.summary_table(df, accuracy=accuracy).collect()}
    filled = sorted(v for v in values if v is not None)
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        rank = next(i for i in range(1, len(filled) + 1) if i >= share * len(filled))
        assert table["x"][name] == filled[rank - 1]
    assert table["k"]["p50"] == 1499.0


def test_approximate_quantiles_come_from_one_sketch(orders):
    table = profile.summary_table(orders.select("sum_qty"), exact=False).first()
    exact = profile.summary_table(orders.select("sum_qty")).first()
    assert table["p50"] == pytest.approx(exact["p50"], rel=0.02)


def test_split_sizes_add_up(orders):
    row = profile.split_sizes(orders, F.col("label") == 1).first()
    assert row["n_all"] == row["n_train"] + row["n_validation"] == orders.count()


def rows_by_column(table):
    return {r["column"]: r for r in table.collect()}


def scans_since(spark, before):
    store = spark._jsparkSession.sharedState().statusStore()
    held = store.executionsList(before, store.executionsCount() - before)
    plans = [held.apply(i).physicalPlanDescription() for i in range(held.size())]
    return sum("scanned_numbers" in plan for plan in plans)


@pytest.mark.parametrize("near", [100, 100_000])
def test_exact_table_takes_three_scans(spark, tmp_path, monkeypatch, near):
    monkeypatch.setattr(profile, "NEAR_ROWS", near)
    path = str(tmp_path / "scanned_numbers")
    made = spark.range(200_000).select(
        (F.xxhash64("id") % 1_000_003).alias("x"), F.rand(3).alias("y"), F.lit("t").alias("t")
    )
    made.write.parquet(path)
    df = spark.read.parquet(path)
    before = spark._jsparkSession.sharedState().statusStore().executionsCount()
    got = rows_by_column(profile.summary_table(df))
    assert 1 < scans_since(spark, before) <= 3
    for c in ("x", "y"):
        values = sorted(r[0] for r in df.select(F.col(c).cast("double")).collect())
        assert [got[c][p] for p in ("p25", "p50", "p75")] == [values[50_000 - 1], values[100_000 - 1], values[150_000 - 1]]
    assert got["t"]["p50"] is None and got["t"]["n"] == 200_000


def test_stored_sketches_of_parts_give_those_of_the_whole(spark, orders, tmp_path):
    path = str(tmp_path / "sketches")
    for part in (0, 1, 2):
        profile.column_sketches(orders.filter(F.col("o_orderkey") % 3 == part)).write.mode("append").parquet(path)
    merged = profile.merge_sketches(spark.read.parquet(path))
    got, want = rows_by_column(merged), rows_by_column(profile.describe_table(orders))
    assert set(got) == set(want)
    for c, row in want.items():
        assert got[c]["n"] == row["n"] and got[c]["min_text"] == row["min_text"]
        for name in ("mean", "stddev", "min", "max"):
            assert got[c][name] == (None if row[name] is None else pytest.approx(row[name]))
    exact = rows_by_column(profile.summary_table(orders))
    about = rows_by_column(profile.sketched_quantiles(merged))
    # Fewer values than the sketch holds, so that it is exact.
    assert about["sum_qty"]["p50"] == exact["sum_qty"]["p50"]
    assert about["c_mktsegment"]["p50"] is None


def test_nan_null_infinite_and_repeated_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(nan, None, -inf, 5.0, nan)] * 3 + [(1.0, None, 2.0, 5.0, nan)] * 5 + [(None, None, inf, 5.0, nan)] * 2
    df = spark.createDataFrame(rows, "some DOUBLE, none DOUBLE, ends DOUBLE, same DOUBLE, `a.b` DOUBLE")
    for exact in (True, False):
        got = rows_by_column(profile.summary_table(df, exact=exact))
        assert got["some"]["p50"] == 1.0 and math.isnan(got["some"]["p75"])
        assert got["none"]["p50"] is None and got["none"]["n"] == 0
        assert (got["ends"]["p25"], got["ends"]["p50"]) == (-inf, 2.0)
        assert got["same"]["p75"] == 5.0 and math.isnan(got["a.b"]["p25"])


def test_summary_of_an_empty_table_and_without_columns(spark):
    empty = spark.createDataFrame([], "x DOUBLE, t STRING")
    got = rows_by_column(profile.summary_table(empty))
    assert set(got) == {"x", "t"} and all(r["n"] == 0 and r["p50"] is None for r in got.values())
    assert profile.summary_table(spark.range(3).select(F.array("id").alias("a"))).count() == 0
