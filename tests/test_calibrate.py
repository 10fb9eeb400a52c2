"""Probabilities of margins."""

import math

import pytest
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators import explain
from tallygrove.operators.calibrate import fitted_curve, train_calibrated, uncalibrated
from tallygrove.operators.evaluate import ranking_report
from tallygrove.operators.scoring import score_table
from tallygrove.operators.selection import actual_params
from tallygrove.operators.splits import hash_split
from tallygrove.plans.fixtures import ORDER_SPEC
from tallygrove.sources.models import load_model, save_model


def curve(spark, rows):
    return fitted_curve(spark.createDataFrame(rows, "score DOUBLE, pos LONG, neg LONG"))


def test_two_margins_have_a_closed_form(spark):
    """With two margins the curve passes through both rates."""
    fitted = curve(spark, [(-1.0, 10, 30), (3.0, 60, 20)])
    slope = (math.log(3) - math.log(1 / 3)) / 4
    assert fitted.getOrDefault("slope") == pytest.approx(slope, abs=1e-6)
    assert fitted.getOrDefault("intercept") == pytest.approx(math.log(1 / 3) + slope, abs=1e-6)


@pytest.mark.parametrize(
    "rows,rate", [([], 0.5), ([(1.0, 3, 1)], 0.75), ([(1.0, 0, 2), (2.0, 0, 3)], None), ([(0.0, 4, 0), (1.0, 1, 0)], None)]
)
def test_nothing_to_tell_apart(spark, rows, rate):
    fitted = curve(spark, rows)
    assert fitted.getOrDefault("slope") == 0.0
    p = 1 / (1 + math.exp(-fitted.getOrDefault("intercept")))
    assert 0 < p < 1
    if rate is not None:
        assert p == pytest.approx(rate)


def test_stored_svm_is_scored(spark, orders, tmp_path):
    inside, outside = hash_split(orders, ORDER_SPEC.key)
    model = train_calibrated(inside, ORDER_SPEC, params={"maxIter": 10}, folds=3)
    path = str(tmp_path / "svm")
    save_model(model, path)
    table = score_table(load_model(path), outside, ORDER_SPEC.key)
    rows = table.select(class_score("rawPrediction").alias("m"), class_score("probability").alias("p"), "prob").collect()
    ordered = sorted(rows, key=lambda r: r["m"])
    assert all(a["p"] <= b["p"] for a, b in zip(ordered, ordered[1:]))
    assert all(0 < r["p"] < 1 and r["prob"] == pytest.approx(r["p"], abs=1e-6) for r in rows)
    rate = outside.agg(F.avg("label")).first()[0]
    assert sum(r["p"] for r in rows) / len(rows) == pytest.approx(rate, abs=0.05)
    assert score_table(model, outside, form="classes").columns[:3] == ["predict", "p0", "p1"]
    assert actual_params(model)["maxIter"] == "10"
    assert ranking_report({"a": model.transform(outside)}).areas.first()["auc"] > 0.85
    # Contributions are those of the margin, with or without the curve.
    one = explain.contributions(model, outside, ORDER_SPEC, inside).orderBy("o_orderkey", "feature").collect()
    assert one == explain.contributions(uncalibrated(model), outside, ORDER_SPEC, inside).orderBy("o_orderkey", "feature").collect()
