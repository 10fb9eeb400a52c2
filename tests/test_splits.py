import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallygrove.functions.expressions import key_hash
from tallygrove.operators import splits

KEY = ("o_orderkey",)


def keys(df):
    return {r["o_orderkey"] for r in df.select("o_orderkey").collect()}


def test_random_split_is_disjoint_and_complete(orders):
    a, b = splits.random_split(orders, [0.8, 0.2], 42)
    assert keys(a) | keys(b) == keys(orders)
    assert not keys(a) & keys(b)


def test_hash_split_does_not_depend_on_partitions(orders):
    inside, outside = splits.hash_split(orders, KEY, 0.8, 42)
    again, _ = splits.hash_split(orders.repartition(3), KEY, 0.8, 42)
    assert keys(inside) == keys(again)
    assert keys(inside) | keys(outside) == keys(orders)
    assert not keys(inside) & keys(outside)
    assert 0.75 < len(keys(inside)) / orders.count() < 0.85


@pytest.mark.parametrize("rate, share", [(0.0, 0), (1.0, 1)])
def test_hash_split_at_the_ends(orders, rate, share):
    inside, _ = splits.hash_split(orders, KEY, rate)
    assert inside.count() == share * orders.count()


def test_hash_split_without_key_keeps_copies_together(spark):
    df = spark.createDataFrame([(i % 50, "x") for i in range(500)], "a INT, b STRING")
    inside, outside = splits.hash_split(df, (), 0.5)
    assert inside.count() + outside.count() == 500
    assert inside.intersect(outside).count() == 0


def test_folds_are_independent_of_the_split(orders):
    inside, _ = splits.hash_split(orders, KEY, 0.5)
    sizes = [r["count"] for r in splits.assign_fold(inside, KEY, 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5
    assert min(sizes) > 0.7 * max(sizes)


def test_n_way_split_is_complete(orders):
    parts = splits.hash_split_n(orders, KEY, [0.5, 0.3])
    assert sum(p.count() for p in parts) == orders.count()
    assert set.union(*map(keys, parts)) == keys(orders)
    with pytest.raises(ValueError):
        splits.assign_part(orders, KEY, [0.8, 0.4], 42)


def test_sample_by_leaves_out_classes_without_a_share(orders):
    sampled = splits.sample_by(orders, "label", {1: 1.0}, KEY)
    assert sampled.count() == orders.filter("label = 1").count()


@pytest.mark.parametrize("frac", [0.0, 0.01, 0.37, 0.6, 1.0])
def test_stratified_split_takes_the_exact_share(orders, frac):
    inside, outside = splits.stratified_split(orders, "label", KEY, frac, 7)
    ranked = orders.withColumn(
        "r",
        F.row_number().over(Window.partitionBy("label").orderBy(key_hash(KEY, 7))),
    ).withColumn("n", F.count("*").over(Window.partitionBy("label")))
    wanted = ranked.filter(F.col("r") <= F.floor(F.lit(frac) * F.col("n")))
    assert keys(inside) == keys(wanted)
    assert keys(inside) | keys(outside) == keys(orders)


def test_stratified_split_keeps_copies_of_a_key_together(spark):
    rows = [(i if i >= 300 else 1, i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "k INT, label INT")
    inside, outside = splits.stratified_split(df, "label", ("k",), 0.5)
    assert inside.count() + outside.count() == 900
    both = inside.select("k", "label").intersect(outside.select("k", "label"))
    assert both.count() == 0


def test_ratios_that_miss_one_by_rounding_leave_nothing_over(orders):
    numbered = splits.assign_part(orders, KEY, [0.7, 0.2, 0.1], 42)
    plan = numbered._jdf.queryExecution().analyzed().toString()
    assert "ffffffff" not in plan
    assert {r["part"] for r in numbered.select("part").distinct().collect()} == {0, 1, 2}
    assert splits.hash_split_n(orders, KEY, [0.7, 0.2, 0.1])[3].count() == 0


def test_stratified_split_of_many_classes(spark):
    df = spark.range(60_000).select(
        F.col("id").alias("k"), (F.col("id") % 5_000).alias("c"), F.lit("x").alias("_class")
    )
    df = df.unionAll(spark.createDataFrame([(-1, None, "y")], df.schema))
    inside, outside = splits.stratified_split(df, "c", ("k",), 0.3, 3)
    order = Window.partitionBy("c").orderBy(key_hash(("k",), 3))
    wanted = df.filter("c is not null").withColumn("r", F.row_number().over(order)).filter("r <= floor(0.3 * 12)")
    assert inside.columns == df.columns
    assert {r["k"] for r in inside.collect()} == {r["k"] for r in wanted.collect()}
    assert inside.count() + outside.count() == 60_001


@pytest.mark.parametrize("rate", [0.0, 0.33, 0.8, 1.0])
def test_copies_of_one_row_are_dealt_to_both_sides(spark, rate):
    df = spark.range(10_000).select(F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"))
    inside, outside = splits.deal_split(df, rate)
    assert abs(inside.count() - 10_000 * rate) <= 1
    assert inside.count() + outside.count() == 10_000
    assert inside.columns == df.columns and inside.schema == outside.schema


def test_dealing_keeps_every_row_and_ignores_partitions(spark, monkeypatch):
    rows = spark.range(3_000).select(
        (F.col("id") % 700).alias("_n"),
        F.when(F.col("id") % 700 < 5, F.lit(None)).otherwise(F.lit("t")).alias("x.y"),
        F.array(F.col("id") % 2).alias("list"),
    )
    rows = rows.unionAll(spark.range(2_500).select(F.lit(9_999), F.lit("hot"), F.array(F.lit(1)).cast("array<bigint>")))
    inside, outside = splits.deal_split(rows, 0.8, 7)
    both = inside.unionAll(outside)
    assert both.exceptAll(rows).count() == rows.exceptAll(both).count() == 0
    assert 0.75 < inside.count() / rows.count() < 0.85
    monkeypatch.setattr(splits, "BLOCK", 100)
    again, _ = splits.deal_split(rows.repartition(5), 0.8, 7)
    assert again.exceptAll(inside).count() == inside.exceptAll(again).count() == 0


def test_dealing_an_empty_table_and_a_wrong_rate(spark):
    inside, outside = splits.deal_split(spark.createDataFrame([], "a INT"), 0.5)
    assert inside.count() == outside.count() == 0
    with pytest.raises(ValueError, match="rate"):
        splits.deal_split(spark.range(3), 1.5)
