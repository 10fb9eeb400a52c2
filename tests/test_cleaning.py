"""Reading and cleaning, with the edge cases of delimited text."""

import pytest

from tallygrove.operators.prepare import (
    binary_label,
    drop_columns,
    feature_columns,
    prepare,
    replace_sentinel,
)
from tallygrove.plans.spec import CENSUS, CENSUS_SCHEMA
from tallygrove.sources.tables import read_table

LINES = """|1x3 Cross validator
39, State-gov, 77516, HS, 13, M, Adm, Own, W, Male, 2174, 0, 40, X, <=50K.
50, ?, 83311, HS, 13, M, ?, Own, W, Male, 0, 0, 13, ?, >50K.

38, Private, , BA, 9, D, Han, Not, W, Male, 0, 0, 40, X, >50K
"""


@pytest.fixture(scope="module")
def census(tmp_path_factory):
    path = tmp_path_factory.mktemp("census") / "census.csv"
    path.write_text(LINES)
    return str(path)


def test_without_header_a_banner_is_an_empty_row(spark, census):
    rows = prepare(read_table(spark, census, CENSUS_SCHEMA), CENSUS).collect()
    assert len(rows) == 4
    first = rows[0].asDict()
    assert first.pop("label") == 0
    assert set(first.values()) == {None}
    assert [r["label"] for r in rows] == [0, 0, 1, 1]


def test_header_line_is_skipped(spark, census):
    raw = read_table(spark, census, CENSUS_SCHEMA, header=True)
    rows = raw.collect()
    assert len(rows) == 3
    # A blank before the digits: an integer column reads NULL, a double column reads the number.
    assert {r["education_num"] for r in rows} == {None}
    assert [r["fnlwgt"] for r in rows] == [77516.0, 83311.0, None]
    assert [r["age"] for r in rows] == [39, 50, 38]


def test_blanks_are_kept_and_only_listed_columns_lose_the_marker(spark, census):
    df = prepare(read_table(spark, census, CENSUS_SCHEMA, header=True), CENSUS)
    rows = df.collect()
    assert [r["workclass"] for r in rows] == [" State-gov", "NA", " Private"]
    assert [r["occupation"] for r in rows] == [" Adm", "NA", " Han"]
    assert [r["native_country"] for r in rows] == [" X", "NA", " X"]
    assert "education_num" not in df.columns and "income_level" not in df.columns
    assert len(feature_columns(df, "label")) == 13


def test_label_is_optional(spark, census):
    raw = read_table(spark, census, CENSUS_SCHEMA)
    assert "label" not in prepare(raw, CENSUS, with_label=False).columns
    unlabelled = prepare(raw.drop("income_level"), CENSUS.using(label_source=None))
    assert "label" not in unlabelled.columns


def test_label_by_substring(spark):
    df = spark.createDataFrame([(" >50K.",), (" <=50K",), (">50K",), (None,)], "income STRING")
    assert [r["label"] for r in binary_label(df, "income", ">50K").collect()] == [1, 0, 1, 0]


def test_sentinel_is_compared_with_equality(spark):
    df = spark.createDataFrame([(" ?", " ?"), ("?", "x"), (" ? ", None), (None, None)], "a STRING, b STRING")
    rows = replace_sentinel(df, ["a"]).collect()
    assert [r["a"] for r in rows] == ["NA", "?", " ? ", None]
    assert [r["b"] for r in rows] == [" ?", "x", None, None]


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    assert drop_columns(df, "a", "c").columns == ["b"]


def test_prepare_is_one_projection(spark, census):
    df = prepare(read_table(spark, census, CENSUS_SCHEMA), CENSUS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project") == 1
    assert "education_num" not in plan.split("ReadSchema")[1]
