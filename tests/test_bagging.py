"""Forests grown from counts of equal rows are those of single rows."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators import bagging, selection
from tallygrove.operators.bagging import BaggedForest, Bags
from tallygrove.operators.classifiers import counted_rows, make_estimator
from tallygrove.operators.explain import tree_nodes
from tallygrove.operators.features import feature_pipeline
from tallygrove.plans.spec import TableSpec
from tallygrove.sources.models import load_model, save_model
from tallygrove.sources.scratch import scratch_path

SPEC = TableSpec(categorical=("kind", "sort"), numeric=("x", "n"), key=("id",))


@pytest.fixture(scope="module")
def rows(spark):
    """Rows without a kind or a number, rows that come twice, keys that are null."""
    noise = F.pmod(F.xxhash64("at"), F.lit(100))
    made = spark.range(4000).withColumnRenamed("id", "at").select(
        F.when(F.col("at") % 19 > 0, F.col("at")).alias("id"),
        F.when(F.col("at") % 7 > 0, F.concat(F.lit("k"), F.col("at") % 3)).alias("kind"),
        F.concat(F.lit("s"), F.pmod(F.xxhash64("at", F.lit(2)), F.lit(4))).alias("sort"),
        F.when(F.col("at") % 11 > 0, F.pmod(F.xxhash64("at", F.lit(3)), F.lit(90)) / 4).alias("x"),
        F.when(F.col("at") % 17 > 0, F.pmod(F.xxhash64("at", F.lit(4)), F.lit(6))).cast("int").alias("n"),
        (F.pmod(F.xxhash64("at", F.lit(3)), F.lit(90)) + (F.col("at") % 3) * 20 + noise > 110).cast("int").alias("label"),
    )
    table = made.unionAll(made.filter("id % 10 = 0")).persist()
    yield table
    table.unpersist()


def _nodes(model, spark):
    told = tree_nodes(model, spark).withColumns({c: F.round(c, 9) for c in ("impurity", "gain")})
    return {tuple(map(str, r)) for r in told.collect()}


@pytest.mark.parametrize(
    "params",
    [
        {"maxDepth": 6, "numTrees": 1},
        {"maxDepth": 5, "numTrees": 2, "impurity": "entropy", "minInstancesPerNode": 40},
        {"maxDepth": 5, "numTrees": 1, "minWeightFractionPerNode": 0.02, "minInfoGain": 0.003, "maxBins": 200},
        {"maxDepth": 0, "numTrees": 1},
    ],
)
def test_trees_are_those_of_spark_where_nothing_is_drawn(spark, rows, params):
    settings = {"bootstrap": False, "featureSubsetStrategy": "all", **params}
    forest = make_estimator("random_forest", settings, 7, "label", SPEC)
    features = feature_pipeline(SPEC).fit(rows)
    ready = features.transform(rows)
    with counted_rows(rows, SPEC) as (counted, _):
        grown = BaggedForest.of(forest, Bags(counted, features, SPEC)).fit(ready)
    plain = forest.fit(ready)
    assert _nodes(grown, spark) == _nodes(plain, spark)
    assert (grown.getNumTrees, grown.numFeatures, grown.numClasses) == (plain.getNumTrees, plain.numFeatures, 2)
    scores = [
        {tuple(r) for r in m.transform(ready).select("id", F.round(class_score("probability"), 9), "prediction").collect()}
        for m in (grown, plain)
    ]
    assert scores[0] == scores[1]


def _rules(**changes):
    settings = {"depth": 3, "entropy": False, "per_node": 2, "bootstrap": True, "rate": 1.0}
    return bagging.Rules(**{**settings, "least_rows": 1, "least_gain": 0.0, "seed": 1, **changes})


def test_equal_rows_are_drawn_one_by_one():
    random, rows = np.random.default_rng(3), np.full(20_000, 400)
    for rate in (1.0, 0.5):
        together = _rules(rate=rate).draw(rows, random)
        single = random.poisson(rate, (20_000, 400)).sum(1)
        assert together.mean() == pytest.approx(single.mean(), rel=0.01)
        assert together.var() == pytest.approx(single.var(), rel=0.05)
    without = _rules(bootstrap=False, rate=0.5).draw(rows, random)
    assert without.max() <= 400 and without.var() == pytest.approx(100, rel=0.05)
    assert (_rules(bootstrap=False).draw(rows, random) == rows).all()


def _by_spark(monkeypatch):
    """The rows of the fits that are left to Spark."""
    seen, fit = [], RandomForestClassifier._fit_java
    monkeypatch.setattr(
        RandomForestClassifier, "_fit_java", lambda self, df: seen.append(df.count()) or fit(self, df)
    )
    return seen


def test_a_search_does_not_go_through_single_rows_for_its_forests(rows, monkeypatch):
    by_spark, kept, shared = _by_spark(monkeypatch), [], selection._Shared
    monkeypatch.setattr(selection, "_Shared", lambda *a: kept.append(shared(*a)) or kept[-1])
    tried = [selection.Candidate("random_forest", {"numTrees": n, "maxDepth": 4}) for n in (5, 20)]
    found = selection.search(rows, SPEC, tried, folds=2)
    assert not by_spark
    assert len(kept) == 2 and all(len(s.kept) == 1 and s.uses == 0 for s in kept)
    assert [t.rounds for t in found.trials] == [[5, 5], [20, 20]]
    # As many rows as there are lie in the bags, give or take; and the forests rank as well as Spark's.
    roots = tree_nodes(found.leader.stages[-1], rows.sparkSession).filter("id = 0")
    assert roots.agg(F.avg("rawCount")).first()[0] == pytest.approx(rows.count(), rel=0.03)
    monkeypatch.setattr(bagging, "MOST_CELLS", 0)
    plain = selection.search(rows, SPEC, tried, folds=2)
    assert len(by_spark) == 5 and by_spark[-1] == rows.count() and sum(by_spark) == 3 * rows.count()
    assert [t.mean for t in found.trials] == pytest.approx([t.mean for t in plain.trials], abs=0.03)


def test_forests_do_not_hang_on_partitions_and_can_be_stored(spark, rows):
    tried = [selection.Candidate("random_forest", {"numTrees": 6, "maxDepth": 4})]
    leaders = [selection.search(t, SPEC, tried, folds=2).leader for t in (rows.coalesce(1), rows.repartition(5))]
    path = scratch_path(spark, "model")
    save_model(leaders[0], path)
    scores = [
        sorted(map(tuple, m.transform(rows).select("id", F.round(class_score("probability"), 9)).na.fill(-1).collect()))
        for m in (*leaders, load_model(path))
    ]
    assert scores[0] == scores[1] == scores[2]
    assert selection.actual_params(leaders[0])["maxDepth"] == "4"


def test_other_labels_and_infinite_numbers_are_left_to_spark(rows, monkeypatch):
    by_spark, features = _by_spark(monkeypatch), feature_pipeline(SPEC).fit(rows)

    def fit(changed):
        forest = make_estimator("random_forest", {"numTrees": 2}, 1, "label", SPEC)
        with counted_rows(changed, SPEC) as (counted, _):
            return BaggedForest.of(forest, Bags(counted, features, SPEC)).fit(features.transform(changed))

    assert fit(rows.withColumn("label", F.when(F.col("n") == 5, 2).otherwise(F.col("label")))).numClasses == 3
    with pytest.raises(Exception, match="Infinity"):
        fit(rows.withColumn("x", F.when(F.col("n") == 5, F.lit(float("inf"))).otherwise(F.col("x"))))
    assert by_spark == [rows.count()] * 2
    for params in ({"featureSubsetStrategy": "3"}, {"maxBins": 600}):
        assert not bagging.can_bag(make_estimator("random_forest", params))
