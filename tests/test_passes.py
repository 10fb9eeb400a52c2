"""How often costly rows are gone through, and over how many partitions."""

import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import functions as F

from tallygrove.catalog import queries
from tallygrove.functions.expressions import class_score
from tallygrove.operators import evaluate, selection
from tallygrove.operators.classifiers import held, make_estimator, train
from tallygrove.operators.features import build_pipeline
from tallygrove.plans.fixtures import ORDER_SPEC
from tallygrove.plans.spec import TableSpec


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reports_do_not_score_the_rows_again(scored):
    model, _, _, table = scored
    assert "UDF" in _plan(table)
    bundle = evaluate.performance_bundle({"a": table, "b": table.limit(50)})
    folded = table.withColumn("fold", F.col("o_orderkey") % 3)
    for report in (bundle, evaluate.cv_metrics_summary(folded)):
        assert "UDF" not in _plan(report)
    row = bundle.filter("part = 'a'").first()
    plain = evaluate.performance(table).first()
    assert row["auc"] == pytest.approx(evaluate.area_under_roc(table), abs=1e-12)
    for name in plain.asDict():
        assert row[name] == pytest.approx(plain[name], abs=1e-12), name


def test_counted_rows_give_the_metrics_of_single_rows(scored):
    table = scored[-1]
    for score in ("probability", "rawPrediction"):
        points = evaluate.judged_points(table, score)
        assert evaluate.judged_area(points) == pytest.approx(evaluate.area_under_roc(table, score), abs=1e-12)
        got, wanted = evaluate.judged_performance(points).first(), evaluate.performance(table).first()
        assert got.asDict() == pytest.approx(wanted.asDict(), abs=1e-12)


def test_rows_without_class_or_of_an_empty_table(scored):
    table = scored[-1].withColumn("label", F.when(F.col("o_orderkey") % 4 > 0, F.col("label")))
    for rows in (table, table.limit(0)):
        got = evaluate.judged_performance(evaluate.judged_points(rows)).first()
        assert got.asDict() == pytest.approx(evaluate.performance(rows).first().asDict(), abs=1e-12)


def test_features_of_a_fold_are_made_once_for_all_candidates(orders, monkeypatch):
    filled = []
    shared = selection._Shared
    monkeypatch.setattr(selection, "_Shared", lambda *a: filled.append(shared(*a)) or filled[-1])
    grid = {"smoothing": (0.5, 1.0, 2.0)}
    selection.cross_validate(orders, ORDER_SPEC, "naive_bayes", grid, folds=2)
    assert [(s.filled, s.uses) for s in filled] == [(True, 0)] * 2
    assert not any(part.storageLevel.useMemory for s in filled for part in s.parts)


def test_balanced_rows_fill_all_cores_more_than_once(spark):
    cores = spark.sparkContext.defaultParallelism
    numbers = ("x", "y", "z")
    drawn = (F.rand(i).alias(c) for i, c in enumerate(numbers))
    rows = spark.range(1_500_000).select("id", *drawn, F.lit(1).alias("label"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        with held(rows, TableSpec(categorical=(), numeric=numbers, key=("id",)), balance=True) as data:
            assert data.count() == 1_500_000
            assert data.rdd.getNumPartitions() >= 2 * cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


CATEGORIES = ORDER_SPEC.using(categorical=("o_orderstatus", "c_mktsegment"), numeric=())


def _rows_of_fits(monkeypatch, kind):
    """The rows that each fit of a classifier is given."""
    seen, fit = [], kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    return seen


def test_linear_models_on_categories_go_over_counted_rows(orders, monkeypatch):
    rows = orders.withColumn("c_mktsegment", F.when(F.col("o_orderkey") % 5 > 0, F.col("c_mktsegment")))
    rows = rows.unionAll(rows.filter("o_orderkey % 3 = 0"))
    combinations = rows.select(*CATEGORIES.categorical, "label").distinct().count()
    params = {"tol": 1e-10}
    plain = build_pipeline(CATEGORIES, make_estimator("logistic_regression", params)).fit(rows)
    seen = _rows_of_fits(monkeypatch, LogisticRegression)
    model = train(rows, CATEGORIES, "logistic_regression", params)
    assert seen == [combinations]
    assert not model.stages[-1].isDefined("weightCol")
    got, wanted = (
        {tuple(r) for r in m.transform(rows).select("o_orderkey", F.round(class_score("probability"), 4)).collect()}
        for m in (model, plain)
    )
    assert got == wanted


def test_penalties_and_numbers_keep_single_rows(orders, monkeypatch):
    seen = _rows_of_fits(monkeypatch, LinearSVC)
    train(orders, CATEGORIES, "linear_svm", {"maxIter": 2, "regParam": 0.1})
    train(orders, ORDER_SPEC, "linear_svm", {"maxIter": 2})
    assert seen == [orders.count()] * 2


def test_an_order_table_that_is_read_more_than_once_is_joined_once(spark, monkeypatch):
    joined, saved = [], queries.saved_table
    monkeypatch.setattr(queries, "saved_table", lambda df, name: joined.append(name) or saved(df, name))
    inside, outside = queries._stored_bands(spark, "/root/testdata/sf0.001")
    assert joined == ["banded"]
    assert "Join" not in _plan(inside) + _plan(outside)
    assert "Join" not in _plan(queries._stored_parts(spark, "/root/testdata/sf0.001")[1])
    monkeypatch.setattr(queries, "_parts", None)
    monkeypatch.setattr(queries, "train", lambda *_, **__: joined.append("train"))
    monkeypatch.setattr(queries.explain, "contributions", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        queries.path_additivity(spark, "/root/testdata/sf0.001")
    assert joined == ["banded", "prepared", "prepared", "train"]


def test_a_search_report_counts_the_scored_rows_once(scored, monkeypatch):
    table = scored[-1]
    folded = table.withColumn("fold", (F.col("o_orderkey") % 3).cast("int"))
    counted, count = [], evaluate.judged_points
    monkeypatch.setattr(evaluate, "judged_points", lambda *a: counted.append(a) or count(*a))
    bundle, by_fold = evaluate.search_report(table, folded)
    assert len(counted) == 1
    assert "UDF" not in _plan(bundle) + _plan(by_fold)
    wanted = evaluate.performance_bundle({"train": table, "cv": folded}), evaluate.cv_metrics_summary(folded)
    for got, want, keys in zip((bundle, by_fold), wanted, (["part"], ["metric", "fold"])):
        got, want = ([r.asDict() for r in t.orderBy(*keys).collect()] for t in (got, want))
        assert len(got) == len(want) > 0
        for one, other in zip(got, want):
            names = {k for k, v in other.items() if isinstance(v, float)}
            assert {k: one[k] for k in names} == pytest.approx({k: other[k] for k in names}, abs=1e-12)
            assert {k: v for k, v in one.items() if k not in names} == {k: v for k, v in other.items() if k not in names}
    bare = folded.drop("probability")
    assert evaluate.search_report(bare, bare, score="rawPrediction")[1] is None
