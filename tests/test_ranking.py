"""Areas, thresholds, gains and lift against plain loops over sorted rows."""

import math

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallygrove.operators import evaluate as ev


def scored(spark, rows):
    df = spark.createDataFrame(rows, "score DOUBLE, label INT")
    return df.select(
        "label", array_to_vector(F.array(1 - F.col("score"), F.col("score"))).alias("probability")
    )


def naive(rows, groups):
    rows = sorted(rows, key=lambda r: -r[0])
    n, n_pos = len(rows), sum(label for _, label in rows)
    points, gains = [], {}
    for s in sorted({s for s, _ in rows}, reverse=True):
        above = [r for r in rows if r[0] > s]
        own = [r for r in rows if r[0] == s]
        tp = sum(label for _, label in above + own)
        points.append((s, tp, len(above) + len(own) - tp))
        gains.setdefault(len(above) * groups // n + 1, []).extend(own)
    area, before = 0.0, 0
    for _, tp, fp in points:
        area += (tp - before) / n_pos * tp / (tp + fp)
        before = tp
    return points, {g: (len(r), sum(label for _, label in r)) for g, r in gains.items()}, area


@pytest.mark.parametrize("n,steps", [(500, 1000), (500, 7), (40, 3), (3, 2)])
def test_against_loops(spark, n, steps):
    rows = [((i * 7919 % steps) / steps, int(i * 31 % 5 > 2 or i % steps == 0)) for i in range(n)]
    points, gains, area = naive(rows, 16)
    n_pos = sum(label for _, label in rows)
    report = ev.ranking_report({"a": scored(spark, rows), "b": scored(spark, rows[: n // 2 + 2])})
    areas = {r["part"]: r for r in report.areas.collect()}
    assert areas["a"]["auc_pr"] == pytest.approx(area)
    assert areas["a"]["auc"] == pytest.approx(ev.area_under_roc(scored(spark, rows)))
    got = {r["group"]: (r["n"], round(r["response_rate"] * r["n"])) for r in report.gains.filter("part = 'a'").collect()}
    assert got == gains
    last = report.gains.filter("part = 'a'").orderBy(F.desc("group")).first()
    assert last["cumulative_capture_rate"] == 1.0 and last["cumulative_lift"] == pytest.approx(1.0)
    assert last["cumulative_share"] == 1.0 and abs(last["kolmogorov_smirnov"]) < 1e-12
    best = {r["criterion"]: r for r in report.thresholds.filter("part = 'a'").collect()}
    f1 = max((2 * tp / (tp + fp + n_pos), s) for s, tp, fp in points)
    assert (best["f1"]["value"], best["f1"]["threshold"]) == pytest.approx(f1)
    assert best["f1"]["threshold"] == pytest.approx(ev.max_f1_threshold(scored(spark, rows)))
    assert best["recall"]["value"] == 1.0
    assert best["precision"]["threshold"] == max(s for s, tp, fp in points if tp / (tp + fp) == best["precision"]["value"])
    assert 0 <= best["absolute_mcc"]["value"] <= 1 and len(best) == 10


def test_one_class_and_no_rows(spark):
    ones = [(i / 9, 1) for i in range(9)]
    report = ev.ranking_report({"ones": scored(spark, ones), "none": scored(spark, [])})
    areas = {r["part"]: r for r in report.areas.collect()}
    assert set(areas) == {"ones"} and areas["ones"]["auc"] is None and areas["ones"]["auc_pr"] == pytest.approx(1.0)
    best = {r["criterion"]: r for r in report.thresholds.collect()}
    assert best["absolute_mcc"]["value"] is None and best["absolute_mcc"]["threshold"] is None
    assert best["specificity"]["value"] is None
    assert best["f1"]["value"] == 1.0
    assert all(r["lift"] == 1.0 and math.isclose(r["gain"], 0, abs_tol=1e-9) for r in report.gains.collect())
    zeros = ev.ranking_report({"zeros": scored(spark, [(0.5, 0)] * 4)})
    assert zeros.areas.first()["auc_pr"] is None
    row = zeros.gains.collect()
    assert len(row) == 1 and row[0]["n"] == 4 and row[0]["lift"] is None


def test_curve_is_written_once(spark):
    report = ev.ranking_report({"a": scored(spark, [(0.1, 0), (0.4, 1)])})
    for table in (report.areas, report.thresholds, report.gains):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Window" not in plan and "Join" not in plan
