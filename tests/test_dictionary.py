import pytest
from pyspark.sql import functions as F

from tallygrove.operators import dictionary as dic
from tallygrove.operators import features
from tallygrove.plans.fixtures import ORDER_SPEC


def test_equals_the_indexer_on_the_order_table(orders):
    columns = [*ORDER_SPEC.categorical, "n_lines"]
    made = dic.category_dictionary(orders, columns)
    names = ["o_orderkey", *(f"{c}_idx" for c in columns)]
    ours = dic.index_by_dictionary(orders, made).select(names)
    theirs = features.index_categories(orders, columns).select(names)
    assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_vectors_equal_those_of_the_encoder(orders):
    columns = ORDER_SPEC.categorical
    made = dic.category_dictionary(orders, columns)
    vectors = [f"{c}_vec" for c in columns]
    ours = dic.one_hot_by_dictionary(orders, made)
    theirs = features.one_hot(orders, columns)
    kept = {r["o_orderkey"]: [r[v] for v in vectors] for r in theirs.collect()}
    assert all([r[v] for v in vectors] == kept[r["o_orderkey"]] for r in ours.collect())
    whole = features.assemble(ours, [*vectors, "label"]).first()["features"]
    assert whole.size == sum(made.sizes.values()) + 1


def test_nulls_unknown_values_ties_and_names(spark):
    train = spark.createDataFrame(
        [(v, None, 1) for v in ["b", "a", "c", "c", None]], "`x.y` STRING, empty STRING, value INT"
    )
    made = dic.category_dictionary(train, ["x.y", "empty", "value"])
    assert made.sizes == {"x.y": 3, "empty": 0, "value": 1}
    rows = spark.createDataFrame(
        [("c", "q", 1), ("a", None, 1), ("b", None, 2), ("new", None, 1), (None, None, None)],
        "`x.y` STRING, empty STRING, value INT",
    )
    got = dic.one_hot_by_dictionary(rows.withColumn("index", F.lit("kept")), made)
    assert got.columns[:4] == ["x.y", "empty", "value", "index"]
    by_value = {r["x.y"]: r for r in got.collect()}
    assert {v: r["x.y_idx"] for v, r in by_value.items()} == {"c": 0, "a": 1, "b": 2, "new": 3, None: 3}
    assert by_value["a"]["x.y_vec"].toArray().tolist() == [0, 1, 0]
    assert by_value["new"]["x.y_vec"].numNonzeros() == 0
    assert {r["empty_idx"] for r in by_value.values()} == {0.0}
    assert by_value["b"]["value_idx"] == 1.0


def test_an_empty_table_and_no_column(spark):
    empty = spark.createDataFrame([], "c STRING")
    made = dic.category_dictionary(empty, ["c"])
    assert made.sizes == {"c": 0} and dic.index_by_dictionary(empty, made).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        dic.category_dictionary(empty, [])


def test_a_column_of_a_million_values(spark, tmp_path):
    """Every value but one has the same count, so all of them meet in one tie."""
    n = 1_000_000
    text = F.lpad(F.col("id").cast("string"), 7, "0").alias("c")
    rows = spark.range(n).select(text).unionAll(spark.range(300_000).select(F.lit("0777777").alias("c")))
    made = dic.category_dictionary(rows, ["c"], str(tmp_path / "dictionary"))
    again = dic.load_dictionary(spark, made.path, ["c"])
    assert again.sizes == {"c": n}
    place = F.col("value").cast("long")
    wanted = F.when(place == 777_777, 0).when(place < 777_777, place + 1).otherwise(place)
    assert again.table.filter(F.col("index") != wanted).count() == 0
    indexed = dic.one_hot_by_dictionary(rows, again)
    assert indexed.filter("c_idx is null").count() == 0
    assert indexed.filter("c = '0777777' and c_idx = 0").count() == 300_001
    assert "attrs" not in indexed.schema["c_vec"].metadata["ml_attr"]
    assert len(indexed._jdf.queryExecution().analyzed().toString()) < 20_000
