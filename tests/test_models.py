import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tallygrove.operators import evaluate, scoring, selection
from tallygrove.operators.classifiers import CLASSIFIERS, held, make_estimator, score_column, train
from tallygrove.operators.features import build_pipeline
from tallygrove.operators.splits import assign_fold, hash_split
from tallygrove.plans.fixtures import ORDER_SPEC
from tallygrove.sources.models import load_leader, load_model, save_leader, save_model

# Floors well below what the order table gave when it was measured.
FLOORS = {
    "random_forest": 0.86,
    "gbt": 0.86,
    "linear_svm": 0.86,
    "logistic_regression": 0.87,
    "decision_tree": 0.85,
    "naive_bayes": 0.80,
}


@pytest.mark.parametrize("algorithm", sorted(CLASSIFIERS))
def test_area_floor(orders, algorithm):
    inside, outside = hash_split(orders, ORDER_SPEC.key)
    params = {"gbt": {"maxIter": 5}, "linear_svm": {"maxIter": 30}}.get(algorithm)
    model = train(inside, ORDER_SPEC, algorithm, params)
    scored = model.transform(outside)
    assert evaluate.area_under_roc(scored, score_column(algorithm)) > FLOORS[algorithm]
    if algorithm == "linear_svm":
        assert "probability" not in scored.columns
        for refused in (
            lambda: scoring.positive_probability(scored),
            lambda: evaluate.log_loss(scored),
            lambda: scoring.score_table(model, outside, form="classes"),
        ):
            with pytest.raises(ValueError, match="probability"):
                refused()
        assert "log_loss" not in evaluate.performance(scored).columns


def test_estimators_take_seed_and_settings():
    forest = make_estimator("random_forest", {"numTrees": 7}, seed=5)
    assert (forest.getSeed(), forest.getNumTrees()) == (5, 7)
    assert make_estimator("logistic_regression").getMaxIter() == 100
    with pytest.raises(ValueError, match="unknown algorithm"):
        make_estimator("oracle")


def test_same_result_after_repartition(orders):
    inside, outside = hash_split(orders, ORDER_SPEC.key)
    one = train(inside, ORDER_SPEC, "naive_bayes").transform(outside)
    two = train(inside.repartition(5), ORDER_SPEC, "naive_bayes").transform(outside)
    assert evaluate.area_under_roc(one) == pytest.approx(evaluate.area_under_roc(two), abs=1e-12)


def test_saved_model_gives_equal_scores(spark, scored, tmp_path):
    model, _, outside, expected = scored
    save_model(model, f"{tmp_path}/m")
    save_model(model, f"{tmp_path}/m")
    assert save_leader(model, f"{tmp_path}/") == f"{tmp_path}/automl_leader"
    want = expected.select("o_orderkey", "probability").collect()
    for stored in (load_model(f"{tmp_path}/m"), load_leader(str(tmp_path))):
        got = stored.transform(outside).select("o_orderkey", "probability").collect()
        assert sorted(got) == sorted(want)


def test_score_tables(scored):
    model, _, outside, _ = scored
    table = scoring.score_table(model, outside, ("o_orderkey",))
    assert table.columns == ["o_orderkey", "rawPrediction", "probability", "prediction", "prob"]
    assert dict(table.dtypes)["prob"] == "float"
    classes = scoring.score_table(model, outside, form="classes")
    assert classes.columns == ["predict", "p0", "p1", *outside.columns]
    assert classes.filter(F.abs(F.col("p0") + F.col("p1") - 1) > 1e-9).isEmpty()
    kept = scoring.score(model, outside, drop_label=True)
    assert kept.columns == [
        *(c for c in outside.columns if c != "label"), "rawPrediction", "probability", "prediction",
    ]
    assert "features" in scoring.score(model, outside, keep="features").columns


def test_scoring_stays_in_the_jvm(scored):
    model, _, outside, _ = scored
    table = scoring.score_table(model, outside, ("o_orderkey",))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("InMemoryRelation")[0]


@pytest.mark.parametrize("quantiles, per_range", [(1, 1_000), (7, 5), (1_000, 100_000)])
def test_grouped_area_equals_the_evaluator(scored, monkeypatch, quantiles, per_range):
    monkeypatch.setattr(evaluate, "SCORE_QUANTILES", quantiles)
    monkeypatch.setattr(evaluate, "SCORES_PER_RANGE", per_range)
    *_, table = scored
    points = evaluate.score_points(table, evaluate.positive_score(table))
    curve = evaluate.score_curve(points, per_range=per_range)
    last = curve.orderBy("score").first()
    assert (last["tp"], last["fp"]) == (last["n_pos"], last["n_neg"])
    groups = evaluate.area_by_group(table, ["o_orderstatus"]).collect()
    for row in groups:
        part = table.filter(F.col("o_orderstatus") == row["o_orderstatus"])
        assert row["auc"] == pytest.approx(evaluate.area_under_roc(part), abs=1e-12)


def test_max_f1_against_every_threshold(scored):
    *_, table = scored
    rows = [(r["p"], r["label"]) for r in table.select(
        evaluate.positive_score(table).alias("p"), "label").collect()]

    def f1(cut):
        tp = sum(1 for p, y in rows if p >= cut and y)
        return 2 * tp / (sum(1 for p, _ in rows if p >= cut) + sum(y for _, y in rows))

    best = max({p for p, _ in rows}, key=lambda cut: (f1(cut), cut))
    assert evaluate.max_f1_threshold(table) == best
    cells = {(r["label"], r["predicted"]): r["count"]
             for r in evaluate.confusion_matrix(table, "max_f1").collect()}
    assert cells[(1, 1)] == sum(1 for p, y in rows if p >= best and y)


def test_ties_and_one_class_only(spark):
    from pyspark.ml.functions import array_to_vector

    def table(rows):
        df = spark.createDataFrame(rows, "g STRING, p DOUBLE, label INT")
        vector = array_to_vector(F.array(1 - F.col("p"), F.col("p")))
        called = (F.col("p") > 0.5).cast("double")
        return df.select("g", "label", vector.alias("probability"), called.alias("prediction"))

    ties = table([("a", 0.5, 0), ("a", 0.5, 1), ("a", 0.9, 1), ("b", 0.5, 1), ("b", 0.5, 0),
                  ("c", 0.1, 0), (None, 0.2, 0), (None, 0.4, 1)])
    got = {r["g"]: r["auc"] for r in evaluate.area_by_group(ties, ["g"]).collect()}
    assert got == {"a": 0.75, "b": 0.5, "c": None, None: 1.0}
    nothing = evaluate.performance(ties.limit(0)).first()
    assert (nothing["n"], nothing["accuracy"], nothing["log_loss"]) == (0, None, None)


def test_metric_name():
    assert evaluate.metric_name() == "areaUnderROC"


def test_param_grid_is_every_combination():
    grid = selection.param_grid({"maxDepth": (3, 5, 7), "numTrees": (50, 100, 200)})
    assert len(grid) == 9
    assert grid[1] == {"maxDepth": 3, "numTrees": 100}
    assert selection.param_grid({}) == [{}]


def test_shared_features_give_the_metrics_of_full_refits(orders):
    inside, _ = hash_split(orders, ORDER_SPEC.key)
    found = selection.cross_validate(
        inside, ORDER_SPEC, "naive_bayes", {"smoothing": (0.5, 1.0)}, folds=3
    )
    nb = NaiveBayes()
    cv = CrossValidator(
        estimator=build_pipeline(ORDER_SPEC, nb),
        estimatorParamMaps=ParamGridBuilder().addGrid(nb.smoothing, [0.5, 1.0]).build(),
        evaluator=BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0),
        numFolds=3,
        foldCol="fold",
    ).fit(assign_fold(inside, ORDER_SPEC.key, 3))
    summary = selection.cv_summary(found).orderBy("candidate").collect()
    assert [r["mean_auc"] for r in summary] == pytest.approx(cv.avgMetrics, abs=1e-12)
    assert [r["stddev_auc"] for r in summary] == pytest.approx(cv.stdMetrics, abs=1e-12)
    assert selection.best_params(found)["smoothing"] in (0.5, 1.0)


def test_search_respects_the_clock_and_sorts(orders):
    candidates = [selection.Candidate("naive_bayes", {"smoothing": s}) for s in (4.0, 1.0, 0.5)]
    found = selection.search(orders, ORDER_SPEC, candidates, folds=2, max_runtime_secs=0.0)
    assert len(found.trials) == 1 and found.skipped == candidates[1:]
    short = selection.leaderboard(found).collect()
    assert [(r["rank"], r["status"]) for r in short] == [(1, "done"), (None, "skipped"), (None, "skipped")]
    assert [r["candidate"] for r in short] == [0, 1, 2]
    everything = selection.search(orders, ORDER_SPEC, candidates, folds=2)
    board = selection.leaderboard(everything).collect()
    assert [r["rank"] for r in board] == [1, 2, 3]
    assert [r["auc"] for r in board] == sorted((r["auc"] for r in board), reverse=True)
    assert selection.actual_params(everything.leader)["modelType"] == "multinomial"


def test_search_candidates_are_seeded():
    names = ("gbt", "random_forest", "logistic_regression")
    one = selection.search_candidates(8, names, 42)
    assert one == selection.search_candidates(8, names, 42)
    assert [c.algorithm for c in one[:3]] == list(names)
    assert all(not c.params for c in one[:3])
    assert one != selection.search_candidates(8, names, 43)
    assert {c.algorithm for c in selection.search_candidates()} == {"gbt"}


def test_out_of_fold_rows_are_all_there_once(orders):
    found = selection.cross_validate(orders, ORDER_SPEC, "naive_bayes", folds=3)
    held_out = selection.oof_predictions(orders, ORDER_SPEC, found.best.models)
    assert held_out.count() == orders.count() == held_out.select("o_orderkey").distinct().count()


def test_training_rows_are_not_shuffled(spark, orders, tmp_path):
    orders.write.parquet(f"{tmp_path}/orders")
    stored = spark.read.parquet(f"{tmp_path}/orders")
    for balance in (False, True):
        with held(stored, ORDER_SPEC, balance=balance) as data:
            plan = data._jdf.queryExecution().executedPlan().toString()
            assert ("Exchange" in plan) == balance
