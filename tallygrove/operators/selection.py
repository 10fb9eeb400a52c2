"""Cross-validation, tuning, multi-model search and the tables they report.

Folds come from the row key's hash. The prepared table is cached once, with its fold column; each
fold's feature stages are fitted once and shared by all candidates, which gives the same models as
refitting the whole pipeline for every candidate and fold.
"""

from __future__ import annotations

import random
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from statistics import fmean, pstdev

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallygrove.operators.bagging import BaggedForest, Bags, can_bag, fits_in_tasks
from tallygrove.operators.classifiers import (
    ROWS,
    SECOND_ORDER,
    VALIDATION,
    adaptive_caches,
    can_weigh,
    counted_rows,
    draws_rows,
    fit_weighed,
    held,
    make_estimator,
    marked_for_validation,
    needs_non_negative,
    reads_bins,
    score_column,
    spread_rows,
    watch_validation,
)
from tallygrove.operators.evaluate import (
    area_under_roc,
    judged_area,
    judged_performance,
    judged_points,
    metric_name,
    performance,
)
from tallygrove.operators.features import (
    FEATURES,
    check_inputs,
    feature_pipeline,
    fit_without_parts,
    with_estimator,
)
from tallygrove.operators.splits import assign_fold
from tallygrove.plans.spec import TableSpec

FOLD = "fold"
DONE, SKIPPED, CANCELLED = "done", "skipped", "cancelled"
# What an estimator learns from: counted rows, bags drawn by the counts of equal rows, or single rows.
COUNTED, BAGGED, SINGLE = "counted", "bagged", "single"
# Seconds between two cancellations of a candidate whose time is up: a fit is many jobs.
AGAIN_SECS = 0.2


@dataclass(frozen=True)
class Candidate:
    """One algorithm with its settings."""

    algorithm: str
    params: Mapping[str, object] = field(default_factory=dict)

    def settings(self) -> str:
        return ", ".join(f"{name}={value}" for name, value in self.params.items())


@dataclass
class Trial:
    """A candidate's metric fold by fold. Only the best trial keeps its pipelines."""

    number: int
    candidate: Candidate
    models: list[PipelineModel]
    metrics: list[float]
    errors: list[float]
    losses: list[float | None]
    rounds: list[int | None] = field(default_factory=list)

    @property
    def mean(self) -> float:
        return fmean(self.metrics)

    @property
    def stddev(self) -> float:
        return pstdev(self.metrics)


@dataclass
class SearchResult:
    """Finished trials, candidates that the budget left out, and the winner fitted on all rows.

    ``left_out`` holds (number, candidate, status); a candidate is ``skipped`` if it was not begun and
    ``cancelled`` if its time ran out while it was being fitted.
    """

    spark: SparkSession
    trials: list[Trial]
    left_out: list[tuple[int, Candidate, str]]
    leader: PipelineModel

    @property
    def skipped(self) -> list[Candidate]:
        return [c for _, c, status in self.left_out if status == SKIPPED]

    @property
    def cancelled(self) -> list[Candidate]:
        return [c for _, c, status in self.left_out if status == CANCELLED]

    def ranked(self) -> list[Trial]:
        return sorted(self.trials, key=_order)

    @property
    def best(self) -> Trial:
        return self.ranked()[0]


def param_grid(values: Mapping[str, Sequence]) -> list[dict[str, object]]:
    """Every combination of the given settings, the last one changing fastest."""
    return [dict(zip(values, combination)) for combination in product(*values.values())]


def grid_candidates(algorithm: str, values: Mapping[str, Sequence]) -> list[Candidate]:
    return [Candidate(algorithm, params) for params in param_grid(values)]


def search_candidates(
    max_models: int = 5, algorithms: Sequence[str] = ("gbt",), seed: int = 42
) -> list[Candidate]:
    """A seeded list of candidates: each algorithm's default first, then its variants in turn."""
    grids = {
        "gbt": {"maxDepth": (3, 5, 7), "stepSize": (0.05, 0.1, 0.2), "maxIter": (20, 50)},
        "random_forest": {"maxDepth": (5, 7, 10), "numTrees": (20, 50, 100)},
        "decision_tree": {"maxDepth": (3, 5, 7, 10)},
        "logistic_regression": {"regParam": (0.0, 0.01, 0.1), "elasticNetParam": (0.0, 0.5)},
        "linear_svm": {"regParam": (0.0, 0.01, 0.1)},
        "naive_bayes": {"smoothing": (0.25, 0.5, 1.0, 2.0, 4.0)},
        SECOND_ORDER: {"maxDepth": (3, 4, 6), "stepSize": (0.1, 0.2, 0.3), "l2": (1.0, 5.0)},
    }
    draw = random.Random(seed)
    queues = []
    for algorithm in algorithms:
        default = make_estimator(algorithm, spec=TableSpec((), ()))
        variants = [
            candidate
            for candidate in grid_candidates(algorithm, grids[algorithm])
            if any(
                default.getOrDefault(default.getParam(name)) != value
                for name, value in candidate.params.items()
            )
        ]
        draw.shuffle(variants)
        queues.append([Candidate(algorithm), *variants])
    turns = max(len(queue) for queue in queues)
    ordered = [queue[turn] for turn in range(turns) for queue in queues if turn < len(queue)]
    return ordered[:max_models]


def _at_once(
    session: SparkSession, parallelism: int, work: Callable, items: Iterable
) -> Iterator:
    """Run Spark jobs from several driver threads, which keep the session's job group and tags.

    Results come in the order of the items, each as soon as it and those before it are done.
    """
    with ThreadPoolExecutor(parallelism) as pool:
        yield from pool.map(inheritable_thread_target(session)(work), items)


class _OutOfTime(Exception):
    """A candidate's time ran out before all its folds were done."""


class _Deadline:
    """Ends the Spark jobs of a candidate when its time is up, and nobody else's.

    The calling thread has a job tag meanwhile, which the threads that work for the candidate take over.
    Once the time is up, the jobs with the tag are cancelled again and again until the work is over, since
    a fit may be between two jobs.
    """

    def __init__(self, session: SparkSession, seconds: float | None):
        self.context, self.seconds = session.sparkContext, seconds
        self.tag = f"candidate-{uuid.uuid4().hex}"
        self.over, self.expired = threading.Event(), threading.Event()
        self.clock = threading.Thread(target=self._watch, daemon=True)

    def _watch(self) -> None:
        if not self.over.wait(self.seconds):
            self.expired.set()
            while not self.over.wait(AGAIN_SECS):
                self.context.cancelJobsWithTag(self.tag)

    def __enter__(self) -> _Deadline:
        if self.seconds is not None:
            self.context.addJobTag(self.tag)
            self.clock.start()
        return self

    def __exit__(self, *_) -> None:
        self.over.set()
        if self.seconds is not None:
            self.clock.join()
            self.context.removeJobTag(self.tag)

    def within(self, work: Callable) -> Callable:
        """``work``, in which whatever fails after the time is up is ``_OutOfTime``."""

        def limited(item):
            if self.expired.is_set():
                raise _OutOfTime
            try:
                return work(item)
            except Exception as failure:
                if self.expired.is_set():
                    raise _OutOfTime from failure
                raise

        return limited


def _rounds(model: PipelineModel) -> int | None:
    """Trees of an ensemble; None for other models."""
    rounds = getattr(model.stages[-1], "getNumTrees", None)
    return rounds() if callable(rounds) else rounds


@dataclass(frozen=True)
class _Tables:
    """The rows of a search, and the same with equal rows of a fold counted.

    ``exact`` is whether the counted rows have the rows' own numbers; trees may read others as well.
    ``size`` is how many counted rows there are, if some candidate draws its bags by them.
    """

    rows: DataFrame
    counted: DataFrame
    exact: bool
    spec: TableSpec
    features: PipelineModel
    size: int | None = None

    def learns(self, estimator: Estimator) -> str:
        """What the estimator is fitted on."""
        if can_weigh(estimator) and (self.exact or reads_bins(estimator)):
            return COUNTED
        if self.size is not None and can_bag(estimator):
            if fits_in_tasks(estimator, self.features, self.spec, self.size):
                return BAGGED
        return SINGLE

    def fit(self, estimator: Estimator, table: DataFrame, bags: Bags | None = None):
        if bags is not None:
            estimator = BaggedForest.of(estimator, bags)
        return fit_weighed(estimator, table) if ROWS in table.columns else estimator.fit(table)

    def to_learn(self, kind: str) -> DataFrame:
        return self.counted if kind == COUNTED else self.rows

    def to_judge(self) -> DataFrame:
        return self.counted if self.exact else self.rows


def _trials(
    tables: _Tables,
    spec: TableSpec,
    candidates: Sequence[Candidate],
    features: Sequence[PipelineModel],
    seed: int,
    parallelism: int,
    first: int = 0,
    deadline: _Deadline | None = None,
) -> Iterator[Trial]:
    """Fit and judge the candidates on every fold; fits of several candidates may overlap."""
    made = [make_estimator(c.algorithm, c.params, seed, spec.label, spec) for c in candidates]
    kinds = [tables.learns(estimator) for estimator in made]
    # Forests learn from single rows; others that do so as well share them.
    drawn = {kind for kind, estimator in zip(kinds, made) if kind != COUNTED and draws_rows(estimator)}
    shared = {
        (fold, kind): _Shared(
            tables.to_learn(kind), tables.to_judge(), stages, fold, kinds.count(kind),
            spec if kind in drawn else None,
            Bags(tables.counted.filter(F.col(FOLD) != fold), stages, spec) if kind == BAGGED else None,
        )
        for fold, stages in enumerate(features)
        for kind in set(kinds)
    }

    def one_fold(pair: tuple[int, Candidate]) -> tuple[PipelineModel, float, Row]:
        fold, candidate = pair
        estimator = make_estimator(candidate.algorithm, candidate.params, seed, spec.label, spec)
        if VALIDATION in tables.rows.columns:
            watch_validation(estimator)
        used = shared[fold, tables.learns(estimator)]
        with used as (rest, own):
            fitted = tables.fit(estimator, rest, used.bags)
            scored = fitted.transform(own)
            counts = ROWS if ROWS in own.columns else None
            points = judged_points(scored, score_column(candidate.algorithm), spec.label, rows=counts)
            points = points.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                auc = judged_area(points, spec.label)
                seen = judged_performance(points, spec.label)
                return with_estimator(features[fold], fitted), auc, seen.first()
            finally:
                points.unpersist()

    # Fold by fold, so that the features of a fold are there for all candidates and then make room.
    pairs = list(product(range(len(features)), candidates))
    work = one_fold if deadline is None else deadline.within(one_fold)
    try:
        results = list(_at_once(tables.rows.sparkSession, parallelism, work, pairs))
    finally:
        for each in shared.values():
            each.release()
    for position, candidate in enumerate(candidates):
        models, areas, seen = zip(*results[position :: len(candidates)])
        yield Trial(
            first + position,
            candidate,
            list(models),
            list(areas),
            [row["mean_per_class_error"] for row in seen],
            [row.asDict().get("log_loss") for row in seen],
            [_rounds(model) for model in models],
        )


def _over_folds(table: DataFrame) -> DataFrame:
    """Counted rows added up over the folds; other rows as they are."""
    if ROWS not in table.columns:
        return table
    names = [c for c in table.columns if c not in (FOLD, ROWS)]
    return table.groupBy(*names).agg(F.sum(ROWS).alias(ROWS))


class _Shared:
    """A fold's features, of the rows to learn from and of those to judge by.

    They are cached while several candidates use them, apart from each other: a pass over one part would
    otherwise unpack the vectors of both. Counted rows to learn from are added up over the folds; single
    rows are spread out by their columns in ``spread``, if it is given. Of forests with ``bags`` only the
    rows to judge by are cached: the others are read by their counts.
    """

    def __init__(
        self, learned: DataFrame, judged: DataFrame, stages: PipelineModel, fold: int, uses: int,
        spread: TableSpec | None = None, bags: Bags | None = None,
    ):
        rest, own = learned.filter(F.col(FOLD) != fold), judged.filter(F.col(FOLD) == fold)
        rest = _over_folds(rest) if spread is None else spread_rows(rest, spread)
        # The steps between a column and the vector are not read again.
        self.parts = [
            stages.transform(part).select(*part.columns, FEATURES) for part in (rest, own)
        ]
        self.bags, self.kept = bags, self.parts if bags is None else self.parts[1:]
        self.uses, self.shared, self.filled = uses, uses > 1, False
        self.lock = threading.Lock()

    def __enter__(self) -> list[DataFrame]:
        with self.lock:
            if self.shared and not self.filled:
                self.filled = True
                for part in self.kept:
                    # At once: jobs that meet in a cache being filled wait for each other in the cores.
                    part.persist(StorageLevel.MEMORY_AND_DISK).count()
        return self.parts

    def __exit__(self, *_) -> None:
        with self.lock:
            self.uses -= 1
            if self.uses == 0:
                self.release()

    def release(self) -> None:
        if self.filled:
            for part in self.kept:
                part.unpersist()
        if self.bags is not None:
            self.bags.release()


def _order(trial: Trial) -> tuple[float, int]:
    return (-trial.mean, trial.number)


def search(
    df: DataFrame,
    spec: TableSpec,
    candidates: Sequence[Candidate],
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 8,
    max_runtime_secs: float | None = None,
    balance: bool = False,
    report: Callable[[DataFrame, SearchResult], None] | None = None,
    max_candidate_secs: float | None = None,
    validation_rate: float | None = None,
) -> SearchResult:
    """Cross-validate the candidates and fit the best one on all rows.

    ``report`` is called with the cached rows, which carry their fold, and the result, so that
    tables about the search can be computed before the cache is released.

    With ``max_runtime_secs`` for all of them, or ``max_candidate_secs`` for each, they are tried one
    after the other. A candidate whose time runs out is cancelled while it is being fitted: its jobs end
    and its finished folds are discarded. The first candidate has no limit, so there is a winner, whose
    fit on all rows has none either. Candidates left out are reported. Without limits, the result does
    not depend on speed.

    With ``validation_rate``, that share of every fit's rows, by a hash of the key, trains no boosted
    trees but tells them when to stop; other algorithms use all rows.
    """
    if not candidates:
        raise ValueError("no candidates to search")
    started = time.monotonic()
    folded = assign_fold(df, spec.key, folds, seed, FOLD)
    marks = ()
    if validation_rate is not None:
        folded, marks = marked_for_validation(folded, spec, validation_rate, seed), (VALIDATION,)
    trials: list[Trial] = []
    left_out: list[tuple[int, Candidate, str]] = []

    def note(trial: Trial) -> None:
        trials.append(trial)
        winner = min(trials, key=_order)
        for other in trials:
            if other is not winner:
                other.models = []

    made = [make_estimator(c.algorithm, c.params, seed, spec.label, spec) for c in candidates]
    with (
        held(folded, spec, FOLD, *marks, balance=balance) as data,
        adaptive_caches(df.sparkSession),
        counted_rows(data, spec, FOLD, *marks) as (counted, exact),
    ):
        check_inputs(data, spec, any(map(needs_non_negative, made)))
        fitted = fit_without_parts(counted, spec, ROWS, FOLD, folds) if exact else None
        if fitted is None:
            stages = feature_pipeline(spec)
            rests = [data.filter(F.col(FOLD) != fold) for fold in range(folds)]
            fitted = list(_at_once(df.sparkSession, parallelism, stages.fit, [*rests, data]))
        *features, everything = fitted
        size = counted.count() if any(map(can_bag, made)) else None
        tables = _Tables(data, counted, exact, spec, everything, size)
        if max_runtime_secs is None and max_candidate_secs is None:
            for trial in _trials(tables, spec, candidates, features, seed, parallelism):
                note(trial)
        else:
            for number, candidate in enumerate(candidates):
                limits = [max_candidate_secs] if max_candidate_secs is not None else []
                if max_runtime_secs is not None:
                    limits.append(max_runtime_secs - (time.monotonic() - started))
                if trials and min(limits) <= 0:
                    left_out.append((number, candidate, SKIPPED))
                    continue
                with _Deadline(df.sparkSession, min(limits) if trials else None) as deadline:
                    try:
                        for trial in _trials(
                            tables, spec, [candidate], features, seed, parallelism, number, deadline
                        ):
                            note(trial)
                    except _OutOfTime:
                        left_out.append((number, candidate, CANCELLED))
        best = min(trials, key=_order).candidate
        winner = make_estimator(best.algorithm, best.params, seed, spec.label, spec)
        if marks:
            watch_validation(winner)
        kind = tables.learns(winner)
        rows = tables.to_learn(kind)
        rows = spread_rows(rows, spec) if draws_rows(winner) else _over_folds(rows)
        bags = Bags(counted, everything, spec) if kind == BAGGED else None
        leader = with_estimator(everything, tables.fit(winner, everything.transform(rows), bags))
        if bags is not None:
            bags.release()
        result = SearchResult(df.sparkSession, trials, left_out, leader)
        if report is not None:
            report(data, result)
    return result


def cross_validate(
    df: DataFrame,
    spec: TableSpec,
    algorithm: str,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 8,
) -> SearchResult:
    """Search over one algorithm's parameter grid."""
    return search(df, spec, grid_candidates(algorithm, grid or {}), folds, seed, parallelism)


def auto_search(
    df: DataFrame,
    spec: TableSpec,
    max_models: int = 5,
    max_runtime_secs: float | None = 180.0,
    folds: int = 5,
    seed: int = 42,
    algorithms: Sequence[str] = ("gbt",),
    parallelism: int = 8,
    report: Callable[[DataFrame, SearchResult], None] | None = None,
    max_candidate_secs: float | None = None,
    validation_rate: float | None = None,
) -> SearchResult:
    """Budgeted search over several algorithms."""
    candidates = search_candidates(max_models, algorithms, seed)
    return search(
        df, spec, candidates, folds, seed, parallelism, max_runtime_secs, report=report,
        max_candidate_secs=max_candidate_secs, validation_rate=validation_rate,
    )


def actual_params(model: PipelineModel) -> dict[str, str]:
    """Every parameter of the fitted classifier, set or default; a curve of its margins is left out."""
    fitted = next(s for s in reversed(model.stages) if s.hasParam("labelCol"))
    return {p.name: str(v) for p, v in fitted.extractParamMap().items()}


def params_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    return spark.createDataFrame(
        sorted(actual_params(model).items()), "name STRING, value STRING"
    )


def best_params(result: SearchResult) -> dict[str, object]:
    """The winning candidate's settings as the fitted model reports them."""
    fitted = result.leader.stages[-1]
    return {
        name: fitted.getOrDefault(fitted.getParam(name)) for name in result.best.candidate.params
    }


def cv_summary(result: SearchResult) -> DataFrame:
    """One row per candidate in the order tried: mean and deviation of the metric over folds."""
    return result.spark.createDataFrame(
        [
            (t.number, t.candidate.algorithm, t.candidate.settings(), t.mean, t.stddev)
            for t in result.trials
        ],
        "candidate INT, algorithm STRING, params STRING, mean_auc DOUBLE, stddev_auc DOUBLE",
    )


def fold_metrics(result: SearchResult) -> DataFrame:
    """One row per candidate and fold."""
    return result.spark.createDataFrame(
        [
            (t.number, fold, metric_name(), metric)
            for t in result.trials
            for fold, metric in enumerate(t.metrics)
        ],
        "candidate INT, fold INT, metric STRING, value DOUBLE",
    )


def rounds_table(result: SearchResult) -> DataFrame:
    """Trees of every candidate's fit per fold, for algorithms that have them."""
    return result.spark.createDataFrame(
        [
            (t.number, t.candidate.algorithm, fold, rounds)
            for t in result.trials
            for fold, rounds in enumerate(t.rounds)
            if rounds is not None
        ],
        "candidate INT, algorithm STRING, fold INT, rounds INT",
    )


def leaderboard(result: SearchResult) -> DataFrame:
    """Candidates from best to worst, ties by the order tried; then those that the budget left out.

    Metrics are means over the folds. Models without a probability have no log loss.
    """

    def mean(values: Sequence[float | None]) -> float | None:
        known = [v for v in values if v is not None]
        return fmean(known) if known else None

    tried = [
        (
            rank, t.number, t.candidate.algorithm, t.candidate.settings(),
            t.mean, mean(t.losses), mean(t.errors), DONE,
        )
        for rank, t in enumerate(result.ranked(), start=1)
    ]
    others = [
        (None, number, c.algorithm, c.settings(), None, None, None, status)
        for number, c, status in result.left_out
    ]
    return result.spark.createDataFrame(
        tried + others,
        "rank INT, candidate INT, algorithm STRING, params STRING, auc DOUBLE, log_loss DOUBLE, "
        "mean_per_class_error DOUBLE, status STRING",
    ).orderBy(F.col("rank").asc_nulls_last(), "candidate")


def leader(result: SearchResult) -> PipelineModel:
    return result.leader


def held_out_predictions(folded: DataFrame, models: Sequence[PipelineModel]) -> DataFrame:
    """Each row scored by the model of its fold, which did not see it; one read per fold."""
    parts = [
        model.transform(folded.filter(F.col(FOLD) == fold)) for fold, model in enumerate(models)
    ]
    return reduce(DataFrame.unionByName, parts)


def oof_predictions(
    df: DataFrame,
    spec: TableSpec,
    models: Sequence[PipelineModel],
    seed: int = 42,
) -> DataFrame:
    """``held_out_predictions`` of a table without fold column; ``models`` holds one per fold."""
    return held_out_predictions(assign_fold(df, spec.key, len(models), seed, FOLD), models)


def compare(
    parts: Mapping[str, DataFrame],
    spec: TableSpec,
    algorithms: Sequence[str],
    params: Mapping[str, Mapping[str, object]] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Train each algorithm on ``parts['train']`` and report it on the other parts.

    The training rows are cached once and the feature stages, which do not depend on the algorithm,
    are fitted once.
    """
    rows = []
    with held(parts["train"], spec) as data:
        made = {
            a: make_estimator(a, (params or {}).get(a), seed, spec.label, spec) for a in algorithms
        }
        check_inputs(data, spec, any(map(needs_non_negative, made.values())))
        features = feature_pipeline(spec).fit(data)
        ready = features.transform(data)
        models = {
            a: with_estimator(features, estimator.fit(ready)) for a, estimator in made.items()
        }
    for name, part in parts.items():
        if name == "train":
            continue
        # Each part is read once; the metrics of all models come from the cached rows.
        with held(part, spec) as judged:
            for algorithm, model in models.items():
                scored = model.transform(judged)
                auc = area_under_roc(scored, score_column(algorithm), spec.label)
                seen = performance(scored, spec.label).first()
                rows.append((algorithm, name, auc, seen["accuracy"], seen["mean_per_class_error"]))
    return parts["train"].sparkSession.createDataFrame(
        rows,
        "algorithm STRING, part STRING, auc DOUBLE, accuracy DOUBLE, "
        "mean_per_class_error DOUBLE",
    )
