import pytest

from tallygrove.catalog.queries import TEXT_SPEC, _labelless_text, _profile_text, _trimmed_spec
from tallygrove.operators.evaluate import area_under_roc
from tallygrove.plans import jobs
from tallygrove.plans.spec import CENSUS, JobSpec
from tallygrove.sources.scratch import scratch_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def text(spark):
    return _profile_text(spark, SMALL)


def test_parameters_reach_the_estimator():
    spec = JobSpec(CENSUS, "gbt", max_depth=4, learning_rate=0.01, params={"maxIter": 3})
    assert spec.estimator_params() == {"maxDepth": 4, "stepSize": 0.01, "maxIter": 3}
    forest = spec.using(algorithm="random_forest", params={})
    assert forest.estimator_params() == {"maxDepth": 4}
    assert spec.using(algorithm="naive_bayes", params={}).estimator_params() == {}


def test_session_settings_are_applied(spark):
    session = jobs.open_session(JobSpec(CENSUS, spark_conf={"spark.sql.files.maxRecordsPerFile": "7"}), "t")
    assert session.conf.get("spark.sql.files.maxRecordsPerFile") == "7"
    session.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_scratch_follows_the_checkpoint_setting(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("algorithm", ["random_forest", "linear_svm"])
def test_train_job(spark, text, algorithm):
    params = {"random_forest": {"numTrees": 5}, "linear_svm": {"maxIter": 10}}[algorithm]
    spec = JobSpec(TEXT_SPEC, algorithm, max_depth=4, params=params)
    report = jobs.train_job(spark, spec, text, scratch_path(spark, "model"))
    assert report.auc > 0.8
    assert sum(r["count"] for r in report.counts.collect()) == 1500
    if algorithm == "random_forest":
        assert report.model.stages[-1].getMaxDepth() == 4
        assert sum(r["score"] for r in report.importance.collect()) == pytest.approx(1.0)
    else:
        assert report.importance is None


def test_tune_job_stores_the_best(spark, text):
    spec = JobSpec(TEXT_SPEC, "decision_tree", grid={"maxDepth": (1, 4)}, folds=2)
    report = jobs.tune_job(spark, spec, text, scratch_path(spark, "model"))
    assert report.model.stages[-1].getMaxDepth() == 4
    assert report.auc > 0.8


def test_search_job_then_scores(spark, text):
    spec = JobSpec(
        TEXT_SPEC, algorithms=("decision_tree", "logistic_regression"), max_models=2, folds=2
    )
    report, scores = jobs.train_and_score(
        spark, spec, text, text, scratch_path(spark, "model"), scratch_path(spark, "scores"), True
    )
    assert report.model_path.endswith("/automl_leader")
    assert {r["part"] for r in report.performance.collect()} == {"train", "cv"}
    assert {r["metric"] for r in report.fold_metrics.collect()} >= {"auc", "log_loss"}
    assert scores.columns[:3] == ["predict", "p0", "p1"] and scores.count() == 1500


def test_predict_job_needs_no_label(spark, text):
    train_spec = JobSpec(_trimmed_spec().using(
        schema=None, label_source="revenue_band", dropped=("c_acctbal",)), "naive_bayes")
    from tallygrove.plans.fixtures import order_profile
    path = scratch_path(spark, "profile")
    order_profile(spark, SMALL).write.parquet(path)
    model = scratch_path(spark, "model")
    report = jobs.train_job(spark, train_spec, path, model)
    scores = jobs.predict_job(
        spark, JobSpec(_trimmed_spec()), _labelless_text(spark, SMALL), model,
        scratch_path(spark, "scores"),
    )
    assert scores.columns == ["o_orderkey", "rawPrediction", "probability", "prediction", "prob"]
    assert scores.count() == 1500
    labelled = scores.join(report.model.transform(order_labels(spark)).select("o_orderkey", "label"), "o_orderkey")
    assert area_under_roc(labelled) > 0.8


def order_labels(spark):
    from tallygrove.operators.prepare import prepare
    from tallygrove.plans.fixtures import ORDER_SPEC, order_profile
    return prepare(order_profile(spark, SMALL), ORDER_SPEC)
