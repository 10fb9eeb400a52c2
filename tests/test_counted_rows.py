"""A search fits on counted rows where that gives the same models, and on single rows elsewhere."""

import pytest
from pyspark.ml.classification import GBTClassifier, NaiveBayes, RandomForestClassifier
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators import classifiers, selection
from tallygrove.operators.classifiers import ROWS, VALIDATION, make_estimator, watch_validation
from tallygrove.operators.features import FEATURES, feature_pipeline
from tallygrove.plans.spec import TableSpec

SPEC = TableSpec(categorical=("kind",), numeric=("x", "n"), key=("id",))


@pytest.fixture(scope="module")
def rows(spark):
    """Many equal rows, some of them without a kind or a number, some keys twice."""
    noise = F.pmod(F.xxhash64("id"), F.lit(100))
    made = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("kind"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 13) / 2).alias("x"),
        F.when(F.col("id") % 17 > 0, F.col("id") % 5).alias("n"),
        ((F.col("id") % 13) * 5 + (F.col("id") % 3) * 10 + noise > 90).cast("int").alias("label"),
    )
    table = made.unionAll(made.filter("id % 10 = 0")).persist()
    yield table
    table.unpersist()


def _fits(monkeypatch, kind):
    """The tables that each fit of a classifier is given: their columns and rows."""
    seen, fit = [], kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, df: seen.append((df.columns, df.count())) or fit(self, df))
    return seen


def _scores(model, rows):
    scored = model.transform(rows)
    return {tuple(r) for r in scored.select("id", "prediction", F.round(class_score("probability"), 9)).collect()}


def _plain(rows, algorithm, params, watched=False):
    estimator = make_estimator(algorithm, params, 42, "label", SPEC)
    if watched:
        watch_validation(estimator)
    stages = feature_pipeline(SPEC).fit(rows)
    return stages, estimator.fit(stages.transform(rows))


@pytest.mark.parametrize(
    "algorithm, kind, params", [("gbt", GBTClassifier, {"maxIter": 4}), ("naive_bayes", NaiveBayes, {})]
)
def test_models_are_those_of_single_rows(rows, monkeypatch, algorithm, kind, params):
    stages, plain = _plain(rows, algorithm, params)
    seen = _fits(monkeypatch, kind)
    found = selection.search(rows, SPEC, [selection.Candidate(algorithm, params)], folds=2)
    combinations = rows.select("kind", "x", "n", "label").distinct().count()
    assert len(seen) == 3
    assert all(ROWS in columns and n <= combinations for columns, n in seen)
    wanted = _scores(plain, stages.transform(rows))
    assert _scores(found.leader, rows) == wanted
    assert not found.leader.stages[-1].isDefined("weightCol")


def test_early_stopping_and_metrics_are_those_of_single_rows(rows, monkeypatch):
    candidate = selection.Candidate("gbt", {"maxIter": 12, "maxDepth": 3, "stepSize": 0.8})
    counted = selection.search(rows, SPEC, [candidate], folds=2, validation_rate=0.3)
    monkeypatch.setattr(selection, "can_weigh", lambda _: False)
    single = selection.search(rows, SPEC, [candidate], folds=2, validation_rate=0.3)
    for name in ("metrics", "errors", "losses", "rounds"):
        assert getattr(counted.best, name) == pytest.approx(getattr(single.best, name), abs=1e-9), name


def test_forests_and_limits_on_rows_keep_single_rows(rows, monkeypatch):
    seen = _fits(monkeypatch, RandomForestClassifier)
    selection.search(rows, SPEC, [selection.Candidate("random_forest", {"numTrees": 3})], folds=2)
    assert all(ROWS not in columns for columns, _ in seen)
    assert seen[-1][1] == rows.count()
    for params in ({"subsamplingRate": 0.5}, {"minInstancesPerNode": 5}):
        assert not classifiers.can_weigh(make_estimator("gbt", params))
    assert not classifiers.can_weigh(make_estimator("logistic_regression", {"regParam": 0.1}))
    assert not classifiers.can_weigh(make_estimator("naive_bayes", {"modelType": "gaussian"}))


def test_trees_read_continuous_numbers_by_levels(spark, monkeypatch):
    drawn = spark.range(4000).select("id", F.rand(5).alias("x"), F.randn(6).alias("n"), F.lit("k").alias("kind"))
    drawn = drawn.withColumn("x", F.when(F.col("id") % 9 > 0, F.col("x")))
    rows = drawn.withColumn("label", (F.coalesce("x", F.lit(0.4)) + F.col("n") / 4 > 0.5).cast("int")).persist()
    monkeypatch.setattr(classifiers, "LEVELS", 40)
    with classifiers.counted_rows(rows, SPEC) as (counted, exact):
        assert not exact
        assert counted.agg(F.sum(ROWS)).first()[0] == 4000
        assert counted.select("x").distinct().count() <= 41 and counted.select("n").distinct().count() <= 40
        assert counted.filter("x is null").agg(F.sum(ROWS)).first()[0] == rows.filter("x is null").count()
    # Rows go the way of the value that stands for them.
    levels = classifiers._levels(rows, ("n",))
    values, cuts = levels["n"]
    both = classifiers._on_levels(rows.withColumn("own", F.col("n")), levels)
    for low, high in zip(values, values[1:]):
        cut = (low + high) / 2
        assert both.filter((F.col("own") <= cut) != (F.col("n") <= cut)).count() == 0
    fits = [_fits(monkeypatch, kind) for kind in (GBTClassifier, NaiveBayes)]
    positive = rows.withColumn("n", F.col("n") + 10)
    tried = [selection.Candidate("naive_bayes"), selection.Candidate("gbt", {"maxIter": 3, "maxBins": 40})]
    found = selection.search(positive, SPEC, tried, folds=2)
    assert [all((ROWS in columns) == counts for columns, _ in seen) for counts, seen in zip((True, False), fits)] == [True] * 2
    assert found.best.candidate.algorithm == "gbt" and found.best.mean > 0.95
    rows.unpersist()


def test_forests_learn_on_all_cores(spark, rows, monkeypatch):
    seen, fit = [], RandomForestClassifier._fit

    def watched(self, df):
        sizes = df.groupBy(F.spark_partition_id().alias("part")).count().collect()
        seen.append((df.rdd.getNumPartitions(), [r["count"] for r in sizes]))
        return fit(self, df)

    monkeypatch.setattr(RandomForestClassifier, "_fit", watched)
    tried = [selection.Candidate("random_forest", {"numTrees": n}) for n in (2, 3)]
    # No row has a key that would tell it from others.
    few = rows.withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id"))).coalesce(1)
    selection.search(few, SPEC, tried, folds=2)
    cores = spark.sparkContext.defaultParallelism
    assert len(seen) == 5
    assert all(parts == cores and max(sizes) - min(sizes) <= cores for parts, sizes in seen)
    learned = [sum(sizes) for _, sizes in seen]
    assert learned[-1] == rows.count() and sum(learned[:-1]) == 2 * rows.count()
    # Forests of the same rows in one partition draw others of them, and are as good.
    monkeypatch.setattr(selection, "spread_rows", lambda df, spec: df)
    tried = [selection.Candidate("random_forest", {"numTrees": 30})]
    plain = selection.search(few, SPEC, tried, folds=2).best.mean
    monkeypatch.undo()
    assert selection.search(few, SPEC, tried, folds=2).best.mean == pytest.approx(plain, abs=0.02)
