"""Column roles and job parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql.types import StructType

# The census table's columns, in file order, and the roles its columns play.
CENSUS_SCHEMA = (
    "age INT, workclass STRING, fnlwgt DOUBLE, education STRING, education_num INT, "
    "marital_status STRING, occupation STRING, relationship STRING, race STRING, sex STRING, "
    "capital_gain DOUBLE, capital_loss DOUBLE, hours_per_week DOUBLE, native_country STRING, "
    "income_level STRING"
)
CENSUS_CATEGORICAL = (
    "workclass", "education", "marital_status", "occupation",
    "relationship", "race", "sex", "native_country",
)
CENSUS_NUMERIC = ("fnlwgt", "age", "capital_gain", "capital_loss", "hours_per_week")
CENSUS_SENTINEL_COLUMNS = ("workclass", "occupation", "native_country")

# Algorithms that read a depth or a step size from the job parameters.
DEPTH_ALGORITHMS = ("decision_tree", "random_forest", "gbt", "second_order")
STEP_ALGORITHMS = ("gbt", "second_order")


@dataclass(frozen=True)
class TableSpec:
    """What each column of a table is for.

    ``key`` names the columns that identify a row; hash splits use all columns when it is empty.
    ``max_categories`` refuses categorical columns with more distinct values; the fitted index of a
    column is held on the driver and in every task. Without it there is no such limit.
    """

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    schema: str | StructType | None = None
    key: tuple[str, ...] = ()
    label: str = "label"
    label_source: str | None = None
    positive_marker: str | None = None
    sentinel_columns: tuple[str, ...] = ()
    sentinel: str = " ?"
    sentinel_value: str = "NA"
    dropped: tuple[str, ...] = ()
    header: bool = False
    separator: str = ","
    max_categories: int | None = None

    def using(self, **changes) -> "TableSpec":
        return replace(self, **changes)


CENSUS = TableSpec(
    schema=CENSUS_SCHEMA,
    categorical=CENSUS_CATEGORICAL,
    numeric=CENSUS_NUMERIC,
    label_source="income_level",
    positive_marker=">50K",
    sentinel_columns=CENSUS_SENTINEL_COLUMNS,
    dropped=("education_num",),
)


@dataclass(frozen=True)
class JobSpec:
    """Parameters of a training or scoring job.

    ``max_depth``, ``learning_rate`` and ``params`` set the algorithm of a training or tuning job, and
    ``grid`` what tuning varies. A search tries its own candidates of ``algorithms`` within
    ``max_models``, ``max_runtime_secs`` and ``max_candidate_secs``. ``validation_rate`` is the share of
    the training rows that tells boosted trees when to stop.
    """

    table: TableSpec
    algorithm: str = "random_forest"
    # Rate, seed, folds, models, seconds and the leader's name.
    train_rate: float = 0.8
    seed: int = 42
    max_depth: int | None = None
    learning_rate: float | None = None
    params: Mapping[str, object] = field(default_factory=dict)
    grid: Mapping[str, tuple] = field(default_factory=dict)
    folds: int = 5
    parallelism: int = 8
    max_models: int = 5
    max_runtime_secs: float | None = 180.0
    max_candidate_secs: float | None = None
    validation_rate: float | None = None
    algorithms: tuple[str, ...] = ("gbt",)
    leader_name: str = "automl_leader"
    spark_conf: Mapping[str, str] = field(default_factory=dict)

    def using(self, **changes) -> "JobSpec":
        return replace(self, **changes)

    def estimator_params(self) -> dict[str, object]:
        """Estimator settings: depth and step size where the algorithm has them, then ``params``."""
        chosen: dict[str, object] = {}
        if self.max_depth is not None and self.algorithm in DEPTH_ALGORITHMS:
            chosen["maxDepth"] = self.max_depth
        if self.learning_rate is not None and self.algorithm in STEP_ALGORITHMS:
            chosen["stepSize"] = self.learning_rate
        return {**chosen, **self.params}
