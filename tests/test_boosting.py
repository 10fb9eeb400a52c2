"""Second-order trees against a plain version, early stopping, and searches with time limits."""

import json
import math
import time

import pytest
from pyspark.sql import functions as F

from tallygrove.operators import selection
from tallygrove.operators.boosting import SecondOrderBoosting
from tallygrove.operators.classifiers import (
    SECOND_ORDER,
    VALIDATION,
    marked_for_validation,
    round_losses,
    train,
)
from tallygrove.operators.evaluate import area_under_roc
from tallygrove.operators.explain import feature_importance, variable_importance
from tallygrove.operators.splits import hash_split
from tallygrove.plans import jobs
from tallygrove.plans.fixtures import ORDER_SPEC
from tallygrove.plans.spec import JobSpec, TableSpec
from tallygrove.sources.models import load_model, save_model

SPEC = TableSpec(key=("id",), categorical=("it's c", "d"), numeric=("x1", "y"))


def odd_rows(n=400):
    rows = []
    for i in range(n):
        c = (None, "a", "b\\n'q'", "c", "rare")[i % 5 if i % 61 else 4]
        x = None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(i * 37 % 23)
        label = int((x is None) ^ (c == "a") if i % 3 else (x or 0) > 9)
        rows.append((i, c, str(i % 4), x, float(i % 9), label))
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), "id LONG, `it's c` STRING, d STRING, x1 DOUBLE, y DOUBLE, label INT")


def grow(rows, grads, depth, l2, least, step):
    """A tree over (values by column, g, h), as nested tuples; every value of a number is a cut."""
    g, h = (sum(x[k] for x in grads) for k in (0, 1))
    leaf = -g / (h + l2) * step
    if depth == 0:
        return leaf
    best = None

    def score(g, h):
        return g * g / (h + l2)

    for at, column in enumerate((0, 1, 2, 3)):
        values = {r[column] for r in rows}
        if column < 2:
            tried = [(v, False) for v in values]
        else:
            known = sorted(v for v in values if v is not None)
            tried = [(v, side) for v in known[1:] for side in (False, True)]
        for value, side in tried:
            def left(r, column=column, value=value, side=side):
                if column < 2:
                    return r[column] == value
                return side if r[column] is None else r[column] < value

            gl = sum(x[0] for r, x in zip(rows, grads) if left(r))
            hl = sum(x[1] for r, x in zip(rows, grads) if left(r))
            if hl < least or h - hl < least:
                continue
            gain = round((score(gl, hl) + score(g - gl, h - hl) - score(g, h)) / 2, 9)
            order = (-gain, at, side, (value is not None, value))
            if gain > 0 and (best is None or order < best[0]):
                best = (order, left)
    if best is None:
        return leaf
    left = best[1]
    sides = []
    for wanted in (True, False):
        chosen = [(r, x) for r, x in zip(rows, grads) if left(r) == wanted]
        sides.append(grow([r for r, _ in chosen], [x for _, x in chosen], depth - 1, l2, least, step))
    return (left, *sides)


def value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[1] if tree[0](row) else tree[2]
    return tree


def test_against_a_plain_version(odd):
    params = {"maxDepth": 3, "maxIter": 4, "l2": 0.5, "minChildWeight": 2.0, "stepSize": 0.7}
    model = train(odd, SPEC, SECOND_ORDER, params)
    rows = [
        (c, d, None if x is None or math.isnan(x) else x, y) for _, c, d, x, y, _ in odd_rows()
    ]
    labels, margins = [r[-1] for r in odd_rows()], [0.0] * len(rows)
    for _ in range(4):
        chances = [1 / (1 + math.exp(-m)) for m in margins]
        grads = [(p - t, p * (1 - p)) for p, t in zip(chances, labels)]
        tree = grow(rows, grads, 3, 0.5, 2.0, 0.7)
        margins = [m + value(tree, r) for m, r in zip(margins, rows)]
    got = {r["id"]: r["rawPrediction"][1] for r in model.transform(odd).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(margins, abs=1e-9)


def test_unseen_values_and_missing_columns_values_are_scored(odd, tmp_path):
    model = train(odd, SPEC, SECOND_ORDER, {"maxIter": 2})
    strange = odd.withColumns({"it's c": F.lit("never seen"), "y": F.lit(None).cast("double")})
    scored = model.transform(strange)
    assert scored.filter(F.col("prediction").isNull()).count() == 0
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model")).transform(strange)
    assert [r["probability"] for r in again.orderBy("id").collect()] == [
        r["probability"] for r in scored.orderBy("id").collect()
    ]
    gains = model.stages[-1].column_gains()
    assert sum(gains.values()) == pytest.approx(1.0) and set(gains) == {*SPEC.categorical, *SPEC.numeric}
    table = [tuple(r) for r in feature_importance(model, odd).collect()]
    assert dict(table) == pytest.approx(gains)
    assert variable_importance(model, odd).first()["scaled_importance"] == 1.0


def test_nothing_to_split(spark):
    one = spark.createDataFrame([(i, "a", "b", 1.0, 2.0, i % 2) for i in range(10)], "id LONG, `it's c` STRING, d STRING, x1 DOUBLE, y DOUBLE, label INT")
    model = train(one, SPEC, SECOND_ORDER, {"maxIter": 2})
    assert {r["probability"][1] for r in model.transform(one).collect()} == {0.5}
    assert [len(t) for t in model.stages[-1].nodes()] == [1, 1]
    empty = SecondOrderBoosting(categoricalCols=list(SPEC.categorical), numericCols=list(SPEC.numeric))
    assert empty.fit(one.limit(0)).getNumTrees() == 0


def test_written_rounds_change_nothing(odd, monkeypatch):
    from tallygrove.operators import boosting

    params = {"maxDepth": 2, "maxIter": 4}
    want = train(odd, SPEC, SECOND_ORDER, params).stages[-1].round_losses()
    monkeypatch.setattr(boosting, "WRITE_ROUNDS", 2)
    got = train(odd, SPEC, SECOND_ORDER, params).stages[-1].round_losses()
    assert [r[1] for r in got] == pytest.approx([r[1] for r in want])


def noisy(spark):
    rows = [(i, str(i % 3), str(i * 7 % 5), float(i * 7919 % 1000), float(i % 13), (i * 31 % 17 + i % 3) % 2) for i in range(900)]
    return spark.createDataFrame(rows, "id LONG, `it's c` STRING, d STRING, x1 DOUBLE, y DOUBLE, label INT")


def test_early_stopping_cuts_at_the_best_round(spark):
    df = noisy(spark)
    params = {"maxDepth": 3, "maxIter": 25, "stepSize": 0.9, "patience": 2, "minChildWeight": 0.0}
    model = train(df, SPEC, SECOND_ORDER, params, validation_rate=0.3).stages[-1]
    told = [loss for _, _, loss in model.round_losses()]
    assert model.getNumTrees() < 25
    assert told.index(min(told)) == model.getNumTrees()
    assert len(told) - 1 == model.getNumTrees() + 2
    # The marked rows do not depend on how the table is split, and trained nothing.
    marked = marked_for_validation(df, SPEC, 0.3)
    changed = marked.withColumn("label", F.when(F.col(VALIDATION), 1 - F.col("label")).otherwise(F.col("label")))
    other = train(changed.drop(VALIDATION), SPEC, SECOND_ORDER, {**params, "maxIter": 1, "patience": 9}, validation_rate=0.3)
    first = json.loads(model.getOrDefault("trees"))[:1]
    if first and other.stages[-1].nodes():
        assert first == json.loads(other.stages[-1].getOrDefault("trees"))
    with pytest.raises(ValueError):
        train(df, SPEC, "naive_bayes", validation_rate=0.3)


def test_round_losses(orders):
    inside, _ = hash_split(orders, ORDER_SPEC.key)
    model = train(inside, ORDER_SPEC, SECOND_ORDER, {"maxIter": 3, "maxDepth": 2}, validation_rate=0.2)
    marked = marked_for_validation(inside, ORDER_SPEC, 0.2)
    parts = {"train": marked.filter(f"NOT {VALIDATION}"), "validation": marked.filter(VALIDATION)}
    got = {(r["round"], r["part"]): r["loss"] for r in round_losses(model, parts).collect()}
    for i, learned, held in model.stages[-1].round_losses()[1:]:
        assert got[i, "train"] == pytest.approx(learned) and got[i, "validation"] == pytest.approx(held)
    gbt = train(inside, ORDER_SPEC, "gbt", {"maxIter": 3, "maxDepth": 2}, validation_rate=0.2)
    losses = [r["loss"] for r in round_losses(gbt, {"train": parts["train"]}).orderBy("round").collect()]
    assert losses == sorted(losses, reverse=True)
    with pytest.raises(ValueError):
        round_losses(train(inside, ORDER_SPEC, "naive_bayes"), parts)


def test_search_with_second_order_trees(orders):
    """Next to Spark's trees, which they rank at least as well as."""
    inside, outside = hash_split(orders, ORDER_SPEC.key)
    first, second = selection.search_candidates(2, (SECOND_ORDER, "gbt"))
    assert (first.algorithm, second.algorithm) == (SECOND_ORDER, "gbt")
    quick = [
        selection.Candidate(SECOND_ORDER, {"maxIter": 40, "maxDepth": 2, "stepSize": 1.0, "patience": 1}),
        selection.Candidate("gbt", {"maxIter": 5}),
        selection.Candidate("naive_bayes"),
    ]
    found = selection.search(inside, ORDER_SPEC, quick, folds=2, validation_rate=0.2)
    rounds = {(r["candidate"], r["fold"]): r["rounds"] for r in selection.rounds_table(found).collect()}
    assert set(rounds) == {(c, f) for c in (0, 1) for f in (0, 1)}
    assert all(rounds[0, f] < 40 for f in (0, 1))
    board = selection.leaderboard(found).collect()
    assert [r["status"] for r in board] == ["done"] * 3
    assert area_under_roc(found.leader.transform(outside)) > 0.85


def test_cancelled_candidate(spark, orders):
    candidates = [
        selection.Candidate("naive_bayes"),
        selection.Candidate("gbt", {"maxIter": 3000, "maxDepth": 4}),
        selection.Candidate("decision_tree", {"maxDepth": 2}),
    ]
    started = time.monotonic()
    found = selection.search(
        orders, ORDER_SPEC, candidates, folds=2, parallelism=4, max_candidate_secs=30.0
    )
    assert time.monotonic() - started < 150
    assert found.cancelled == [candidates[1]] and found.skipped == []
    board = selection.leaderboard(found).collect()
    assert [r["status"] for r in board] == ["done", "done", "cancelled"]
    assert board[-1]["rank"] is None and board[-1]["candidate"] == 1 and board[-1]["auc"] is None
    # Nothing of the cancelled fit is left running or tagged, and the session works.
    assert not spark.sparkContext.getJobTags()
    assert spark.sparkContext.statusTracker().getActiveJobsIds() == []
    assert orders.groupBy("label").count().count() == 2


def test_failures_are_not_taken_for_lack_of_time(orders):
    bad = [selection.Candidate("gbt", {"maxBins": 2, "maxDepth": 31})]
    with pytest.raises(Exception, match="(?i)depth"):
        selection.search(orders, ORDER_SPEC, bad, folds=2, max_candidate_secs=600.0)


def test_training_job_with_second_order_trees(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    orders.withColumn("revenue_band", F.when(F.col("label") == 1, ">200K").otherwise("<=200K")).drop("label").write.parquet(path)
    table = ORDER_SPEC.using(sentinel_columns=(), dropped=())
    spec = JobSpec(
        table, SECOND_ORDER, max_depth=2, learning_rate=0.5, params={"maxIter": 3}, validation_rate=0.1
    )
    report = jobs.train_job(spark, spec, path, str(tmp_path / "model"))
    assert report.auc > 0.85
    assert report.model.stages[-1].getOrDefault("maxDepth") == 2
    assert report.importance.first()["name"] == "n_lines"
    scores = jobs.predict_job(spark, spec, path, str(tmp_path / "model"), str(tmp_path / "scores"))
    assert scores.count() == orders.count()
