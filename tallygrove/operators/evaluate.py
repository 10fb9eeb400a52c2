"""Metrics of scored tables.

Counts are aggregated by label, class and score before anything else happens, so a metric costs one
pass with map-side combining. Running totals over scores are taken within score ranges, never over
one unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import inf

from pyspark import StorageLevel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators.scoring import require_probability
from tallygrove.sources.scratch import saved_table

# Fixed value: the clip that keeps log loss finite.
LOG_LOSS_CLIP = 1e-15
# Running totals over scores go range by range: cuts at so many quantiles, and between two of them as
# many equal steps as it takes for about this many scores in a range.
SCORE_QUANTILES = 1_000
SCORES_PER_RANGE = 100_000


def _evaluator(score: str, label: str, bins: int) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, numBins=bins, metricName="areaUnderROC"
    )


def metric_name() -> str:
    return BinaryClassificationEvaluator().getMetricName()


def area_under_roc(
    df: DataFrame, score: str = "probability", label: str = "label", bins: int = 0
) -> float:
    """Area under the ROC curve; exact with ``bins=0``, where every distinct score is a point.

    Ranks by ``probability``: the raw scores of naive Bayes and of single trees do not rank rows.
    """
    return _evaluator(score, label, bins).evaluate(df)


def positive_score(df: DataFrame, score: str = "probability") -> Column:
    """The number that ``score`` ranks rows by."""
    if score == "probability":
        require_probability(df)
    return class_score(score)


def score_points(
    df: DataFrame, score: Column, label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives at each distinct score, per group of ``by``."""
    return df.groupBy(*by, score.alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"),
    )


def _ranged(points: DataFrame, per_range: int) -> DataFrame:
    """Add ``_range``, a number that rises with the score; the points are read once to find the cuts."""
    probes = [i / SCORE_QUANTILES for i in range(1, SCORE_QUANTILES)]
    seen = points.agg(
        F.count("score").alias("n"),
        F.min("score").alias("low"),
        F.max("score").alias("high"),
        F.percentile_approx("score", probes, 4 * SCORE_QUANTILES).alias("cuts"),
    ).first()
    inner = sorted(set(seen["cuts"] or [0.0]))
    buckets = Bucketizer(splits=[-inf, *inner, inf], inputCol="score", outputCol="_bucket")
    bucketed = buckets.transform(points).withColumn("_bucket", F.col("_bucket").cast("int"))
    steps = -(-seen["n"] // (SCORE_QUANTILES * per_range)) or 1
    if steps == 1:
        return bucketed.withColumn("_range", F.col("_bucket").cast("long"))
    edges = F.lit([min(seen["low"], inner[0]), *inner, max(seen["high"], inner[-1])])
    low, high = F.get(edges, F.col("_bucket")), F.get(edges, F.col("_bucket") + 1)
    step = F.floor(steps * F.coalesce(F.try_divide(F.col("score") - low, high - low), F.lit(0.0)))
    step = F.least(F.greatest(step, F.lit(0)), F.lit(steps - 1))
    return bucketed.withColumn("_range", F.col("_bucket").cast("long") * steps + step)


def score_curve(
    points: DataFrame, by: Sequence[str] = (), per_range: int = SCORES_PER_RANGE
) -> DataFrame:
    """Add the totals at and above each score of ``score_points``: tp, fp, n_pos, n_neg.

    The distinct scores are cut into ranges whose number grows with theirs. Totals above a range come
    from a table with one row per group and range, totals inside it from a window over the range. The
    points are read twice: once to find the cuts, once for the totals.
    """
    # Keys that cannot be NULL: groups without a value stay in, and both sides of the join below
    # have the same plan, so that Spark computes the points once for the two.
    keyed = (
        _ranged(points, per_range)
        .withColumn("_range", F.coalesce(F.col("_range"), F.lit(-1)))
        .withColumn("_group", F.struct(F.lit(0).alias("_all"), *by))
    )
    downward = Window.partitionBy("_group").orderBy(F.desc("_range"))
    whole = Window.partitionBy("_group")
    totals = (
        keyed.groupBy("_group", "_range")
        .agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
        .select(
            "_group",
            "_range",
            (F.sum("_pos").over(downward) - F.col("_pos")).alias("pos_above"),
            (F.sum("_neg").over(downward) - F.col("_neg")).alias("neg_above"),
            F.sum("_pos").over(whole).alias("n_pos"),
            F.sum("_neg").over(whole).alias("n_neg"),
        )
    )
    inside = Window.partitionBy("_group", "_range").orderBy(F.desc("score"))
    return keyed.join(totals, ["_group", "_range"]).select(
        *by,
        "score",
        "pos",
        "neg",
        (F.col("pos_above") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(inside)).alias("fp"),
        "n_pos",
        "n_neg",
    )


def area_by_group(
    df: DataFrame, by: Sequence[str], score: str = "probability", label: str = "label"
) -> DataFrame:
    """Exact area under the ROC curve of every group at once; reads ``df`` twice.

    NULL for a group with one class only.
    """
    return _curve_area(score_points(df, positive_score(df, score), label, by), by)


def _curve_area(points: DataFrame, by: Sequence[str]) -> DataFrame:
    curve = score_curve(points, by)
    # Each negative ranks below the positives above it and level with half of its ties.
    wins = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2)
    pairs = F.first("n_pos").cast("double") * F.first("n_neg")
    return curve.groupBy(*by).agg(F.try_divide(F.sum(wins), pairs).alias("auc"))


def max_f1_threshold(df: DataFrame, label: str = "label") -> float:
    """The score that, used as the lowest positive score, gives the highest F1."""
    points = score_points(df, positive_score(df), label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        f1 = 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("n_pos"))
        best = score_curve(points).agg(F.max_by("score", F.struct(f1, "score")).alias("score"))
        return best.first()["score"]
    finally:
        points.unpersist()


def log_loss_column(df: DataFrame, label: str = "label") -> Column:
    """Each row's loss, with the probability of the true class clipped away from zero and one."""
    return _clipped_loss(positive_score(df), label)


def _clipped_loss(chance: Column, label: str) -> Column:
    hit = F.when(F.col(label) == 1, chance).otherwise(1 - chance)
    clipped = F.least(F.greatest(hit, F.lit(LOG_LOSS_CLIP)), F.lit(1 - LOG_LOSS_CLIP))
    return -F.ln(clipped)


def log_loss(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.avg(log_loss_column(df, label)).alias("log_loss"))


def predicted_class(df: DataFrame, threshold: float | str | None, label: str = "label") -> Column:
    """The model's own class, or the class at a probability threshold (``'max_f1'`` finds one)."""
    if threshold is None:
        return F.col("prediction").cast("int")
    if threshold == "max_f1":
        threshold = max_f1_threshold(df, label)
    return (positive_score(df) >= F.lit(threshold)).cast("int")


def confusion_matrix(
    df: DataFrame,
    threshold: float | str | None = None,
    label: str = "label",
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows per true and predicted class; cells without rows are left out."""
    return df.groupBy(
        *by,
        F.col(label).cast("int").alias("label"),
        predicted_class(df, threshold, label).alias("predicted"),
    ).agg(F.count("*").alias("count"))


def _cells(predicted: Column, label: str, n: Column | None = None) -> dict[str, Column]:
    truth = F.col(label) == 1
    called = predicted == 1

    def rows(which: Column) -> Column:
        return F.count_if(which) if n is None else F.coalesce(F.sum(F.when(which, n)), F.lit(0))

    return {
        "tp": rows(truth & called),
        "fn": rows(truth & ~called),
        "fp": rows(~truth & called),
        "tn": rows(~truth & ~called),
    }


def _class_error(tp: Column, fn: Column, fp: Column, tn: Column) -> Column:
    return (F.try_divide(fn, tp + fn) + F.try_divide(fp, tn + fp)) / 2


def mean_per_class_error(
    df: DataFrame, threshold: float | str | None = None, label: str = "label"
) -> DataFrame:
    cells = _cells(predicted_class(df, threshold, label), label)
    return df.agg(_class_error(**cells).alias("mean_per_class_error"))


def performance(
    df: DataFrame,
    label: str = "label",
    by: Sequence[str] = (),
    threshold: float | str | None = None,
) -> DataFrame:
    """Counts, accuracy, class error, log loss and the confusion cells, in one pass.

    Tables without a probability get no log loss. The area under the curve needs the scores in
    order, so it is a function of its own.
    """
    predicted = predicted_class(df, threshold, label)
    loss = log_loss_column(df, label) if "probability" in df.columns else None
    return _performance(df, label, by, predicted, loss)


def _performance(
    df: DataFrame, label: str, by: Sequence[str], predicted: Column, loss: Column | None, n: Column | None = None
) -> DataFrame:
    """``performance`` of rows that stand for one row each, or for ``n``."""
    rows = F.count("*") if n is None else F.coalesce(F.sum(n), F.lit(0))
    cells = _cells(predicted, label, n)
    losses = {}
    if loss is not None:
        known = F.when(loss.isNotNull(), n)
        mean = F.avg(loss) if n is None else F.try_divide(F.sum(loss * n), F.sum(known))
        losses = {"log_loss": mean}
    right = cells["tp"] + cells["tn"]
    metrics = {
        "n": rows,
        "accuracy": F.try_divide(right, rows),
        "mean_per_class_error": _class_error(**cells),
        **losses,
        **cells,
    }
    return df.groupBy(*by).agg(*(column.alias(name) for name, column in metrics.items()))


def judged_points(
    df: DataFrame, score: str = "probability", label: str = "label", by: Sequence[str] = (),
    rows: str | None = None,
) -> DataFrame:
    """How many rows (``_n``) share label, class, score and chance, per group of ``by``.

    ``rows`` names the column that says how many rows each stands for, if they are counted already.
    ``judged_performance`` and the areas need no more, so a scored table is gone through once for all.
    """
    scores = {"score": positive_score(df, score)}
    if "probability" in df.columns:
        scores["_chance"] = positive_score(df)
    if score == "probability":
        del scores["score"]
    counted = df.groupBy(*by, label, "prediction", *(c.alias(name) for name, c in scores.items()))
    points = counted.agg((F.count("*") if rows is None else F.sum(rows)).alias("_n"))
    return points if "score" in scores else points.withColumn("score", F.col("_chance"))


def judged_performance(
    points: DataFrame, label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """``performance`` of the rows that ``judged_points`` counted."""
    loss = _clipped_loss(F.col("_chance"), label) if "_chance" in points.columns else None
    return _performance(points, label, by, F.col("prediction").cast("int"), loss, F.col("_n"))


def judged_area(points: DataFrame, label: str = "label") -> float:
    """``area_under_roc`` of the rows that ``judged_points`` counted."""
    return _evaluator("score", label, 0).setWeightCol("_n").evaluate(points)


def max_f1_thresholds(
    df: DataFrame, by: Sequence[str], label: str = "label"
) -> DataFrame:
    """``max_f1_threshold`` of every group at once, as column ``threshold``."""
    curve = score_curve(score_points(df, positive_score(df), label, by), by)
    f1 = 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("n_pos"))
    return curve.groupBy(*by).agg(F.max_by("score", F.struct(f1, "score")).alias("threshold"))


def performance_bundle(
    parts: dict[str, DataFrame],
    label: str = "label",
    score: str = "probability",
    max_f1: bool = False,
) -> DataFrame:
    """``performance`` and area under the curve of several scored tables, in one tagged union.

    With ``max_f1`` the classes are those at each part's best F1 threshold, which is added.
    """
    shown = {label, "prediction", "probability", "rawPrediction"}
    tagged = reduce(
        DataFrame.unionByName,
        (
            part.select(F.lit(name).alias("part"), *(c for c in part.columns if c in shown))
            for name, part in parts.items()
        ),
    )
    if not max_f1:
        return _judged_by(tagged, ["part"], score, label)
    areas = area_by_group(tagged, ["part"], score, label)
    # A row per part: few enough to be looked up in every row.
    best = max_f1_thresholds(tagged, ["part"], label)
    called = positive_score(tagged) >= F.col("threshold")
    judged = tagged.join(best, "part").withColumn("prediction", called.cast("double"))
    return performance(judged, label, ["part", "threshold"]).join(areas, "part")


def _judged_by(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """``performance`` and area by group; the scored rows, which are costly, are gone through once."""
    return _judged_from(saved_table(judged_points(df, score, label, by), "judged-points"), by, label)


def _judged_from(points: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """``_judged_by`` of stored ``judged_points``, whose groups may be finer than ``by``."""
    counted = points.groupBy(*by, "score").agg(
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("_n"))), F.lit(0)).alias("pos"),
        F.coalesce(F.sum(F.when(F.col(label) != 1, F.col("_n"))), F.lit(0)).alias("neg"),
    )
    seen = judged_performance(points, label, by)
    return seen.join(_curve_area(counted, by), list(by))


def _criteria() -> dict[str, Column]:
    """What a threshold at a score of the curve is worth, by each criterion."""
    tp, fp, n_pos, n_neg = (F.col(c).cast("double") for c in ("tp", "fp", "n_pos", "n_neg"))
    fn, tn = n_pos - tp, n_neg - fp
    recall, specificity = F.try_divide(tp, n_pos), F.try_divide(tn, n_neg)

    def f_score(beta: float) -> Column:
        square = beta * beta
        return (1 + square) * tp / ((1 + square) * tp + square * fn + fp)

    correlation = (tp * tn - fp * fn) / F.sqrt((tp + fp) * n_pos * n_neg * (tn + fn))
    return {
        "f1": f_score(1.0),
        "f2": f_score(2.0),
        "f0point5": f_score(0.5),
        "accuracy": (tp + tn) / (n_pos + n_neg),
        "precision": tp / (tp + fp),
        "recall": recall,
        "specificity": specificity,
        "absolute_mcc": F.when((tp + fp > 0) & (tn + fn > 0) & (n_pos > 0) & (n_neg > 0), F.abs(correlation)),
        "min_per_class_accuracy": F.least(recall, specificity),
        "mean_per_class_accuracy": (recall + specificity) / 2,
    }


def best_thresholds(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(criterion, threshold, value): the lowest score to call positive that is best by each criterion.

    All criteria come from one pass over a ``score_curve``. Of equally good scores the highest is taken;
    a criterion that is not defined (one class only) has no threshold.
    """
    rows = [
        F.struct(
            F.lit(name).alias("criterion"),
            F.max_by("score", F.struct(value, "score")).alias("threshold"),
            F.max(value).alias("value"),
        )
        for name, value in _criteria().items()
    ]
    best = curve.groupBy(*by).agg(F.array(*rows).alias("_rows")).select(*by, F.inline("_rows"))
    return best.withColumn("threshold", F.when(F.col("value").isNotNull(), F.col("threshold")))


def gains_lift(curve: DataFrame, groups: int = 16, by: Sequence[str] = ()) -> DataFrame:
    """The gains and lift table of a ``score_curve``: rows by falling score in ``groups`` equal groups.

    Rows of equal score stay together, in the group that their first row falls into, so groups differ in
    size where scores repeat, and one that begins no score is left out. The curve knows the rows above
    each score, so no row is ranked again.
    """
    rows = F.col("n_pos") + F.col("n_neg")
    above = F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    cut = (F.floor(above * groups / rows) + 1).cast("int").alias("group")
    summed = curve.groupBy(*by, cut).agg(
        F.min("score").alias("lower_threshold"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.max("tp").alias("tp"),
        F.max("fp").alias("fp"),
        F.first("n_pos").alias("n_pos"),
        F.first("n_neg").alias("n_neg"),
    )
    n, total = F.col("pos") + F.col("neg"), F.col("n_pos") + F.col("n_neg")
    base = F.col("n_pos") / total
    rate, cumulative = F.col("pos") / n, F.col("tp") / (F.col("tp") + F.col("fp"))
    capture = F.try_divide(F.col("tp").cast("double"), F.col("n_pos"))
    columns = {
        "n": n,
        "lower_threshold": F.col("lower_threshold"),
        "cumulative_share": (F.col("tp") + F.col("fp")) / total,
        "response_rate": rate,
        "lift": F.try_divide(rate, base),
        "cumulative_response_rate": cumulative,
        "cumulative_lift": F.try_divide(cumulative, base),
        "capture_rate": F.try_divide(F.col("pos").cast("double"), F.col("n_pos")),
        "cumulative_capture_rate": capture,
        "gain": 100 * (F.try_divide(rate, base) - 1),
        "cumulative_gain": 100 * (F.try_divide(cumulative, base) - 1),
        "kolmogorov_smirnov": capture - F.try_divide(F.col("fp").cast("double"), F.col("n_neg")),
    }
    return summed.select(*by, "group", *(column.alias(name) for name, column in columns.items()))


def curve_areas(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(auc, auc_pr) of a ``score_curve``; NULL where a class is missing.

    The area under precision and recall is the average precision: each step of the recall weighs the
    precision at its score.
    """
    wins = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2)
    pairs = F.first("n_pos").cast("double") * F.first("n_neg")
    steps = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return curve.groupBy(*by).agg(
        F.try_divide(F.sum(wins), pairs).alias("auc"),
        F.try_divide(steps, F.first("n_pos").cast("double")).alias("auc_pr"),
    )


@dataclass(frozen=True)
class RankingReport:
    """How well scores rank rows, by part: areas, best thresholds, gains and lift."""

    areas: DataFrame
    thresholds: DataFrame
    gains: DataFrame


def ranking_report(
    parts: Mapping[str, DataFrame], label: str = "label", score: str = "probability", groups: int = 16
) -> RankingReport:
    """The three tables of several scored tables, from one curve that is written once.

    Each part is read once, to count its rows by score; everything else comes from those counts.
    """
    counted = reduce(
        DataFrame.unionByName,
        (
            score_points(part, positive_score(part, score), label).select(F.lit(name).alias("part"), "*")
            for name, part in parts.items()
        ),
    )
    curve = saved_table(score_curve(saved_table(counted, "score-points"), ["part"]), "score-curve")
    by = ["part"]
    return RankingReport(curve_areas(curve, by), best_thresholds(curve, by), gains_lift(curve, groups, by))


def cv_metrics_summary(
    oof: DataFrame, label: str = "label", fold: str = "fold"
) -> DataFrame:
    """Long form: one row per metric and fold, plus the mean and deviation over the folds."""
    return _over_folds(_judged_by(oof, [fold], "probability", label), fold)


def search_report(
    rows: DataFrame, held_out: DataFrame, label: str = "label", score: str = "probability", fold: str = "fold"
) -> tuple[DataFrame, DataFrame | None]:
    """``performance_bundle`` of the rows (``train``) and of the rows held out (``cv``), and the latter's
    ``cv_metrics_summary`` if they have a probability. Either table is scored once for both."""
    shown = [c for c in (label, "prediction", "probability", "rawPrediction") if c in held_out.columns]
    parts = (
        rows.select(F.lit("train").alias("part"), F.lit(None).cast("int").alias(fold), *shown),
        held_out.select(F.lit("cv").alias("part"), F.col(fold).cast("int").alias(fold), *shown),
    )
    counted = judged_points(DataFrame.unionByName(*parts), score, label, ["part", fold])
    points = saved_table(counted, "judged-points")
    bundle = _judged_from(points, ["part"], label)
    if "probability" not in shown:
        return bundle, None
    return bundle, _over_folds(_judged_from(points.filter(F.col("part") == "cv"), [fold], label), fold)


def _over_folds(per_fold: DataFrame, fold: str) -> DataFrame:
    metrics = ["auc", "accuracy", "mean_per_class_error", "log_loss"]
    long = per_fold.unpivot([fold], metrics, "metric", "value")
    over_folds = Window.partitionBy("metric")
    return long.select(
        "metric",
        fold,
        "value",
        F.avg("value").over(over_folds).alias("mean"),
        F.stddev_samp("value").over(over_folds).alias("stddev"),
    )
