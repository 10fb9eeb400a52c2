"""End-to-end jobs: train, tune, search, score, and train-then-score."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.operators.calibrate import train_calibrated
from tallygrove.operators.classifiers import SECOND_ORDER, score_column, train
from tallygrove.operators.evaluate import area_under_roc, search_report
from tallygrove.operators.explain import feature_importance
from tallygrove.operators.prepare import prepare
from tallygrove.operators.profile import label_distribution
from tallygrove.operators.scoring import score_table
from tallygrove.operators.selection import (
    SearchResult,
    auto_search,
    cross_validate,
    held_out_predictions,
)
from tallygrove.operators.splits import hash_split, in_train
from tallygrove.plans.spec import JobSpec, TableSpec
from tallygrove.sources.models import load_model, leader_path, save_leader, save_model
from tallygrove.sources.tables import read_scores, read_table, write_scores

log = logging.getLogger(__name__)


@dataclass
class JobReport:
    """What a training job found. Tables may be lazy.

    ``auc`` is on the held-out rows, for a search on those that each fold's model did not see.
    """

    model: PipelineModel
    model_path: str
    counts: DataFrame
    auc: float
    importance: DataFrame | None = None
    search: SearchResult | None = None
    performance: DataFrame | None = None
    fold_metrics: DataFrame | None = None


def open_session(spec: JobSpec, name: str) -> SparkSession:
    """A session with the job's Spark settings."""
    builder = SparkSession.builder.appName(name)
    for key, value in spec.spark_conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_input(spark: SparkSession, table: TableSpec, path: str) -> DataFrame:
    """Delimited text where the table has a schema, parquet where it has none."""
    if table.schema is None:
        return spark.read.parquet(path)
    return read_table(spark, path, table.schema, table.header, table.separator)


def _prepared(spark: SparkSession, spec: JobSpec, path: str) -> DataFrame:
    return prepare(read_input(spark, spec.table, path), spec.table)


def _counts(df: DataFrame, spec: JobSpec) -> DataFrame:
    """Rows by split and label, from one pass."""
    inside = in_train(df, spec.table.key, spec.train_rate, spec.seed)
    part = F.when(inside, "train").otherwise("validation").alias("part")
    return df.groupBy(part, spec.table.label).agg(F.count("*").alias("count"))


def _finish(
    spec: JobSpec, model: PipelineModel, path: str, counts: DataFrame, validation: DataFrame,
    algorithm: str, found: SearchResult | None = None,
) -> JobReport:
    save_model(model, path)
    stored = load_model(path)
    scored = stored.transform(validation)
    auc = area_under_roc(scored, score_column(algorithm), spec.table.label)
    log.info("%s saved to %s, validation auc %.6f", algorithm, path, auc)
    trees = hasattr(stored.stages[-1], "featureImportances") or spec.algorithm == SECOND_ORDER
    importance = feature_importance(stored, validation) if trees else None
    return JobReport(stored, path, counts, auc, importance, found)


def train_job(spark: SparkSession, spec: JobSpec, in_path: str, model_path: str) -> JobReport:
    """Read, clean, split, fit, save, then judge the stored model on the held-out rows.

    A linear SVM is stored with probabilities, from ``spec.folds`` more fits.
    """
    df = _prepared(spark, spec, in_path)
    inside, outside = hash_split(df, spec.table.key, spec.train_rate, spec.seed)
    if spec.algorithm == "linear_svm":
        # It has margins only; with the curve of its margins a scoring job can use it.
        model = train_calibrated(
            inside, spec.table, spec.algorithm, spec.estimator_params(), spec.seed, spec.folds, spec.parallelism
        )
    else:
        model = train(
            inside, spec.table, spec.algorithm, spec.estimator_params(), spec.seed,
            validation_rate=spec.validation_rate,
        )
    return _finish(spec, model, model_path, _counts(df, spec), outside, spec.algorithm)


def tune_job(spark: SparkSession, spec: JobSpec, in_path: str, model_path: str) -> JobReport:
    """``train_job`` with the settings chosen by cross-validation over ``spec.grid``."""
    df = _prepared(spark, spec, in_path)
    inside, outside = hash_split(df, spec.table.key, spec.train_rate, spec.seed)
    fixed = {name: (value,) for name, value in spec.estimator_params().items()}
    found = cross_validate(
        inside, spec.table, spec.algorithm, {**fixed, **spec.grid},
        spec.folds, spec.seed, spec.parallelism,
    )
    log.info("chosen settings: %s", found.best.candidate.settings())
    return _finish(
        spec, found.leader, model_path, _counts(df, spec), outside, spec.algorithm, found
    )


def _now(table: DataFrame) -> DataFrame:
    """A report of a few rows, computed at once while its input is cached."""
    return table.sparkSession.createDataFrame(table.collect(), table.schema)


def automl_job(spark: SparkSession, spec: JobSpec, in_path: str, model_path: str) -> JobReport:
    """Search on all rows, judged by cross-validation alone; the leader goes under a fixed name."""
    df = _prepared(spark, spec, in_path)
    label = spec.table.label
    tables: dict[str, DataFrame] = {}

    def report(rows: DataFrame, found: SearchResult) -> None:
        held_out = held_out_predictions(rows, found.best.models)
        tables["counts"] = _now(label_distribution(rows, label))
        kind = score_column(found.best.candidate.algorithm)
        bundle, by_fold = search_report(found.leader.transform(rows), held_out, label, kind)
        tables["performance"] = _now(bundle)
        if by_fold is not None:
            tables["fold_metrics"] = _now(by_fold)

    found = auto_search(
        df, spec.table, spec.max_models, spec.max_runtime_secs, spec.folds, spec.seed,
        spec.algorithms, spec.parallelism, report, spec.max_candidate_secs, spec.validation_rate,
    )
    target = save_leader(found.leader, model_path, spec.leader_name)
    stored = load_model(target)
    log.info("leader %s saved to %s", found.best.candidate, target)
    for _, candidate, status in found.left_out:
        log.warning("%s for lack of time: %s", status, candidate)
    has_trees = hasattr(stored.stages[-1], "featureImportances")
    trees = has_trees or found.best.candidate.algorithm == SECOND_ORDER
    by_part = {row["part"]: row["auc"] for row in tables["performance"].collect()}
    return JobReport(
        stored,
        target,
        tables["counts"],
        by_part["cv"],
        feature_importance(stored, df) if trees else None,
        found,
        tables["performance"],
        tables.get("fold_metrics"),
    )


def predict_job(
    spark: SparkSession,
    spec: JobSpec,
    in_path: str,
    model_path: str,
    out_path: str,
    form: str = "ml",
) -> DataFrame:
    """Score a table, which need not have a label, and write it to parquet."""
    raw = read_input(spark, spec.table, in_path)
    df = prepare(raw, spec.table, with_label=False)
    write_scores(score_table(load_model(model_path), df, spec.table.key, form), out_path)
    return read_scores(spark, out_path)


def score_new_files(
    spark: SparkSession,
    spec: JobSpec,
    in_path: str,
    model_path: str,
    out_path: str,
    progress_path: str,
    form: str = "ml",
    files_per_batch: int | None = None,
) -> int:
    """Score the files that came to ``in_path`` since the last run; how many rows that were.

    ``progress_path`` keeps which files were scored and which output belongs to them, so a run that is
    killed goes on where it was, and a run without new files writes nothing. The scores are added to the
    parquet table at ``out_path``, each row once. ``files_per_batch`` bounds what one batch reads. The
    model of the first run may be replaced between runs; files that were scored stay as they are.
    """
    table = spec.table
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}
    stream = spark.readStream.options(**options)
    if table.schema is None:
        raw = stream.schema(spark.read.parquet(in_path).schema).parquet(in_path)
    else:
        raw = read_table(stream, in_path, table.schema, table.header, table.separator)
    scored = score_table(load_model(model_path), prepare(raw, table, with_label=False), table.key, form)
    writer = scored.writeStream.format("parquet").outputMode("append")
    run = writer.option("checkpointLocation", progress_path).trigger(availableNow=True).start(out_path)
    run.awaitTermination()
    return sum(batch["numInputRows"] for batch in run.recentProgress)


def train_and_score(
    spark: SparkSession,
    spec: JobSpec,
    train_path: str,
    score_path: str,
    model_path: str,
    out_path: str,
    search: bool = False,
) -> tuple[JobReport, DataFrame]:
    """A training job, then a scoring job with the model it stored."""
    if search:
        report = automl_job(spark, spec, train_path, model_path)
        stored = leader_path(model_path, spec.leader_name)
        scores = predict_job(spark, spec, score_path, stored, out_path, form="classes")
    else:
        job = tune_job if spec.grid else train_job
        report = job(spark, spec, train_path, model_path)
        scores = predict_job(spark, spec, score_path, model_path, out_path)
    return report, scores
