"""Batch scoring. One ``transform``; no Python worker, no join."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators.features import (
    FEATURES,
    IMPUTED_SUFFIX,
    INDEX_SUFFIX,
    VECTOR_SUFFIX,
)

# The columns of a scored table.
SCORE_COLUMNS = ("rawPrediction", "probability", "prediction", "prob")


def require_probability(df: DataFrame) -> None:
    if "probability" not in df.columns:
        raise ValueError(
            "these predictions carry no probability (a linear SVM has none of its own); "
            "use rawPrediction or prediction, or train it with calibrate.train_calibrated"
        )


def positive_probability(df: DataFrame) -> DataFrame:
    """Add ``prob``, the positive class's probability as a float."""
    require_probability(df)
    return df.withColumn("prob", class_score("probability").cast("float"))


def score(
    model: PipelineModel,
    df: DataFrame,
    keep: str = "all",
    drop_label: bool = False,
    label: str = "label",
) -> DataFrame:
    """Predictions next to the input columns, or all pipeline columns with ``keep='features'``."""
    scored = model.transform(df)
    if keep == "all":
        derived = [
            c
            for c in scored.columns
            if c not in df.columns
            and (c == FEATURES or c.endswith((IMPUTED_SUFFIX, INDEX_SUFFIX, VECTOR_SUFFIX)))
        ]
        scored = scored.drop(*derived)
    elif keep != "features":
        raise ValueError("keep must be 'all' or 'features'")
    return scored.drop(label) if drop_label else scored


def score_table(
    model: PipelineModel, df: DataFrame, keys: Iterable[str] = (), form: str = "ml"
) -> DataFrame:
    """The table a scoring job writes.

    ``form='ml'``: the keys, then rawPrediction, probability, prediction and prob; a table without a
    key has all input columns instead, so that a score can be told to its row.
    ``form='classes'``: predicted class, p0 and p1, then every input column.
    """
    scored = model.transform(df)
    if form == "ml":
        told = list(keys) or [c for c in df.columns if c not in SCORE_COLUMNS]
        return positive_probability(scored).select(*told, *SCORE_COLUMNS)
    if form != "classes":
        raise ValueError("form must be 'ml' or 'classes'")
    require_probability(scored)
    return scored.select(
        F.col("prediction").cast("int").alias("predict"),
        class_score("probability", 0).alias("p0"),
        class_score("probability", 1).alias("p1"),
        *df.columns,
    )
