"""Probabilities for models that have margins only, as the linear SVM.

A logistic curve of the margin is fitted to out-of-fold margins, so the rows of a margin did not train its
model. The rows are first added up by distinct margin; the curve is then a weighted logistic regression on
that table. It becomes the last stage of the pipeline and is saved with it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators.evaluate import score_points
from tallygrove.operators.selection import Candidate, SearchResult, held_out_predictions, search
from tallygrove.plans.spec import TableSpec
from tallygrove.sources.scratch import saved_table


class MarginCalibration(
    Model, HasRawPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Adds the probability ``1 / (1 + exp(-(slope * margin + intercept)))``."""

    slope = Param(Params._dummy(), "slope", "log-odds per unit of margin", TypeConverters.toFloat)
    intercept = Param(Params._dummy(), "intercept", "log-odds at margin 0", TypeConverters.toFloat)

    def __init__(self, slope: float = 1.0, intercept: float = 0.0):
        super().__init__()
        self._set(slope=slope, intercept=intercept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = class_score(self.getOrDefault("rawPredictionCol"))
        odds = margin * self.getOrDefault("slope") + F.lit(self.getOrDefault("intercept"))
        p = 1 / (1 + F.exp(-odds))
        return dataset.withColumn(self.getOrDefault("probabilityCol"), array_to_vector(F.array(1 - p, p)))


def fitted_curve(points: DataFrame) -> MarginCalibration:
    """The logistic curve of ``score_points``: the most likely one, without a penalty.

    With one class only, or one margin, all rows have the rate of the positives.
    """
    totals = points.agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count_distinct("score").alias("n")
    ).first()
    pos, neg = totals["pos"] or 0, totals["neg"] or 0
    if not pos or not neg or totals["n"] < 2:
        # A rate of 0 or 1 has no finite log-odds; half a row keeps it finite.
        level = F.log(F.lit((pos + 0.5 * (pos == 0)) / (neg + 0.5 * (neg == 0))) if pos or neg else F.lit(1.0))
        return MarginCalibration(0.0, points.sparkSession.range(1).select(level).first()[0])
    weighted = points.select(
        "score",
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("label"), F.col("pos").cast("double").alias("weight")),
                F.struct(F.lit(0.0).alias("label"), F.col("neg").cast("double").alias("weight")),
            )
        ),
    ).filter("weight > 0")
    rows = VectorAssembler(inputCols=["score"], outputCol="x").transform(weighted)
    fit = LogisticRegression(featuresCol="x", weightCol="weight", tol=1e-12, maxIter=200).fit(rows)
    return MarginCalibration(float(fit.coefficients[0]), float(fit.intercept))


def train_calibrated(
    df: DataFrame,
    spec: TableSpec,
    algorithm: str = "linear_svm",
    params: Mapping[str, object] | None = None,
    seed: int = 42,
    folds: int = 5,
    parallelism: int = 8,
) -> PipelineModel:
    """The algorithm fitted on all rows, and the curve of its margins on folds it was not fitted on."""
    seen: dict[str, DataFrame] = {}

    def margins(rows: DataFrame, found: SearchResult) -> None:
        held_out = held_out_predictions(rows, found.best.models)
        points = score_points(held_out, class_score("rawPrediction"), spec.label)
        seen["points"] = saved_table(points, "out-of-fold-margins")

    only = [Candidate(algorithm, params or {})]
    found = search(df, spec, only, folds, seed, parallelism, report=margins)
    return PipelineModel(stages=[*found.leader.stages, fitted_curve(seen["points"])])


def uncalibrated(model: PipelineModel) -> PipelineModel:
    """The pipeline up to its classifier."""
    if isinstance(model.stages[-1], MarginCalibration):
        return PipelineModel(stages=model.stages[:-1])
    return model
