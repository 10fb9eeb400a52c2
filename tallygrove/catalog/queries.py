"""Registered queries: one or more for every operator, each reading the whole test tables.

Vectors are unfolded into scalar columns and doubles rounded, so that results can be compared value
by value. Queries share no fitted models.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators import calibrate, explain, features, prepare, profile, scoring, selection, splits
from tallygrove.operators import evaluate as ev
from tallygrove.operators.dictionary import (
    category_dictionary as build_dictionary,
    index_by_dictionary,
    one_hot_by_dictionary,
)
from tallygrove.operators.classifiers import (
    CLASSIFIERS,
    SECOND_ORDER,
    VALIDATION,
    marked_for_validation,
    round_losses,
    score_column,
    train,
)
from tallygrove.plans import jobs
from tallygrove.plans.fixtures import ORDER_SPEC, load, order_profile
from tallygrove.plans.spec import JobSpec, TableSpec
from tallygrove.sources.models import load_leader, load_model, save_leader, save_model
from tallygrove.sources.scratch import saved_table, scratch_path
from tallygrove.sources.tables import read_scores, read_table, write_scores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ("o_orderkey",)
SEED = 42
RATE = 0.8
FOLDS = 5
# Closed forms of trees need features whose values all fit into Spark's bins.
TREE_SPEC = ORDER_SPEC.using(numeric=("n_lines",))
STUMPS = {
    "decision_tree": {"maxDepth": 1},
    "random_forest": {"maxDepth": 1, "numTrees": 1, "bootstrap": False},
    "gbt": {"maxDepth": 1, "maxIter": 1},
}
SMOOTHINGS = (0.5, 1.0, 4.0)
BAND_SPEC = ORDER_SPEC.using(categorical=("qty_band",), numeric=())
# The order profile as delimited text: blanks after the separators stay in the values.
TEXT_SCHEMA = (
    "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING, c_mktsegment STRING, "
    "n_lines DOUBLE, sum_qty DOUBLE, c_acctbal DOUBLE, revenue_band STRING"
)
TEXT_SPEC = ORDER_SPEC.using(schema=TEXT_SCHEMA, sentinel=" P")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(column: Column | str, places: int = 6) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    # Adding zero turns a negative zero into zero.
    return F.round(column.cast("double"), places) + F.lit(0.0)


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.prepare(order_profile(spark, sf), ORDER_SPEC)


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return splits.hash_split(_prepared(spark, sf), KEY, RATE, SEED)


def _stored_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """``_parts`` of a table that is joined once, for queries that read it fold by fold."""
    return splits.hash_split(saved_table(_prepared(spark, sf), "prepared"), KEY, RATE, SEED)


def _stored_bands(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The parts of ``_banded``, joined once."""
    stored = saved_table(_banded(spark, sf).select(*KEY, "qty_band", "label"), "banded")
    return splits.hash_split(stored, KEY, RATE, SEED)


def _nb(spark: SparkSession, sf: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    inside, outside = _parts(spark, sf)
    return train(inside, ORDER_SPEC, "naive_bayes", seed=SEED), inside, outside


def _nb_scored(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    return model.transform(outside)


def _probabilities(scored: DataFrame) -> DataFrame:
    return scored.select(
        "o_orderkey",
        _r(class_score("probability")).alias("p1"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def _value_row(df: DataFrame, **values: float) -> DataFrame:
    """One row of numbers that a metric action returned."""
    names = ", ".join(f"{name} DOUBLE" for name in values)
    row = df.sparkSession.createDataFrame([tuple(values.values())], names)
    return row.select(*(_r(name).alias(name) for name in values))


# --- sources and sinks -------------------------------------------------------------------------


def _orders_text(spark: SparkSession, sf: str, header: bool) -> str:
    path = scratch_path(spark, "orders-text")
    fields = [
        F.col("o_orderkey").cast("string"),
        F.concat(F.lit(" "), F.col("o_orderstatus")),
        F.concat(F.lit(" "), F.col("o_totalprice").cast("string")),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")),
    ]
    names = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey"]
    (
        load(spark, sf, "orders")
        .select(*(f.alias(n) for f, n in zip(fields, names)))
        .write.option("header", header)
        .option("ignoreLeadingWhiteSpace", False)
        .csv(path)
    )
    return path


def _read_orders_text(spark: SparkSession, path: str, header: bool) -> DataFrame:
    schema = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_custkey INT"
    return read_table(spark, path, schema, header=header).select(
        "o_orderkey",
        "o_orderstatus",
        _r("o_totalprice").alias("o_totalprice"),
        F.col("o_custkey").isNull().cast("int").alias("custkey_missing"),
    )


@query
def read_delimited(spark: SparkSession, sf: str) -> DataFrame:
    return _read_orders_text(spark, _orders_text(spark, sf, False), False)


@query
def read_delimited_header(spark: SparkSession, sf: str) -> DataFrame:
    return _read_orders_text(spark, _orders_text(spark, sf, True), True)


@query
def scores_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    path = scratch_path(spark, "scores")
    # Published twice: readers follow the pointer to the second.
    write_scores(scoring.score_table(model, outside.limit(0), KEY), path)
    write_scores(scoring.score_table(model, outside, KEY), path)
    return _probabilities(read_scores(spark, path))


@query
def model_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    path = scratch_path(spark, "model")
    save_model(model, path)
    return _probabilities(load_model(path).transform(outside))


@query
def leader_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = _parts(spark, sf)
    found = selection.cross_validate(inside, ORDER_SPEC, "naive_bayes", folds=FOLDS)
    path = scratch_path(spark, "search")
    save_leader(selection.leader(found), path)
    return _probabilities(load_leader(path).transform(outside))


# --- projections and predicates ----------------------------------------------------------------


@query
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.drop_columns(load(spark, sf, "orders"), "o_orderdate", "o_totalprice")


@query
def binary_label(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return prepare.binary_label(orders, "o_orderpriority", "URGENT")


@query
def replace_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return prepare.replace_sentinel(orders, ["o_orderstatus", "o_orderpriority"], "P", "NA")


@query
def projection(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")


@query
def feature_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The feature list, with the filled rows of each feature."""
    df = _prepared(spark, sf)
    filled = df.agg(*(F.count(c).alias(c) for c in prepare.feature_columns(df, "label")))
    return filled.unpivot([], filled.columns, "feature", "filled")


@query
def as_category(spark: SparkSession, sf: str) -> DataFrame:
    df = prepare.as_category(_prepared(spark, sf).select("o_orderkey", "n_lines"), ["n_lines"])
    return features.index_categories(df, ["n_lines"]).select(
        "o_orderkey", "n_lines", F.col("n_lines_idx").cast("int").alias("n_lines_idx")
    )


@query
def positive_probability(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.positive_probability(_nb_scored(spark, sf)).select(
        "o_orderkey", _r("prob", 5).alias("prob")
    )


@query
def predictions_with_inputs(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    return scoring.score(model, outside).select(
        *outside.columns,
        _r(class_score("probability")).alias("p1"),
        F.col("prediction").cast("int").alias("prediction"),
    )


@query
def predictions_without_label(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    scored = scoring.score(model, outside, drop_label=True)
    return scored.withColumn("p1", _r(class_score("probability"))).drop(
        "rawPrediction", "probability", "prediction"
    )


@query
def prepare_table(spark: SparkSession, sf: str) -> DataFrame:
    return _prepared(spark, sf)


# --- splits ------------------------------------------------------------------------------------


@query
def random_split(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows go where depends on the partitioning; that the parts are a partition does not."""
    df = _prepared(spark, sf)
    parts = splits.random_split(df, [RATE, 1 - RATE], SEED)
    tagged = [p.select(*KEY, F.lit(i).alias("part")) for i, p in enumerate(parts)]
    per_key = tagged[0].unionByName(tagged[1]).groupBy(*KEY).agg(
        F.count("*").alias("times"), F.max("part").alias("part")
    )
    return per_key.agg(
        F.count("*").alias("n"),
        F.max("times").alias("most_parts_of_a_row"),
        (F.abs(F.avg(1 - F.col("part")) - RATE) < 0.05).alias("near_the_rate"),
    )


@query
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = _parts(spark, sf)
    return inside.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        outside.select("o_orderkey", F.lit("validation").alias("part"))
    )


@query
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = splits.stratified_split(_prepared(spark, sf), "label", KEY, 0.6, SEED)
    return inside.select("o_orderkey", "label", F.lit("first").alias("part")).unionByName(
        outside.select("o_orderkey", "label", F.lit("rest").alias("part"))
    )


@query
def assign_fold(spark: SparkSession, sf: str) -> DataFrame:
    return splits.assign_fold(_prepared(spark, sf), KEY, FOLDS, SEED).select("o_orderkey", "fold")


@query
def sample_by(spark: SparkSession, sf: str) -> DataFrame:
    sampled = splits.sample_by(_prepared(spark, sf), "label", {0: 0.25, 1: 0.5}, KEY, SEED)
    return sampled.select("o_orderkey", "label")


@query
def deal_split(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without their keys, of which many are equal: how many of each go to either side."""
    lines = load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    parts = splits.deal_split(lines, RATE, SEED)
    tagged = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    return tagged[0].unionByName(tagged[1]).groupBy(*lines.columns, "part").agg(F.count("*").alias("n"))


@query
def hash_split_n(spark: SparkSession, sf: str) -> DataFrame:
    numbered = [
        part.select("o_orderkey", F.lit(number).alias("part"))
        for number, part in enumerate(
            splits.hash_split_n(_prepared(spark, sf), KEY, [0.5, 0.25], SEED)
        )
    ]
    return numbered[0].unionByName(numbered[1]).unionByName(numbered[2])


# --- aggregation and exploration ---------------------------------------------------------------


@query
def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    df = _prepared(spark, sf)
    return profile.split_sizes(df, splits.in_train(df, KEY, RATE, SEED))


@query
def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return profile.label_distribution(_parts(spark, sf)[0])


@query
def frequency_table(spark: SparkSession, sf: str) -> DataFrame:
    return profile.frequency_table(load(spark, sf, "events"), "event_type")


@query
def schema_table(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the prepared table, each with its filled rows."""
    df = _prepared(spark, sf)
    filled = df.agg(*(F.count(c).alias(c) for c in df.columns))
    counts = filled.unpivot([], filled.columns, "column", "filled")
    return profile.schema_table(df).join(counts, "column").select(
        "position", "column", "type", "filled"
    )


@query
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return profile.preview(_prepared(spark, sf), 10, KEY)


@query
def describe_table(spark: SparkSession, sf: str) -> DataFrame:
    table = profile.describe_table(_prepared(spark, sf))
    return table.select(
        "column", "n", *(_r(c).alias(c) for c in ("mean", "stddev", "min", "max")),
        "min_text", "max_text",
    )


@query
def summary_table(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_partkey", "l_returnflag"
    )
    table = profile.summary_table(lines)
    texts = ("column", "n", "min_text", "max_text")
    return table.select(*texts, *(_r(c, 4).alias(c) for c in table.columns if c not in texts))


@query
def merged_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of four parts of the lines, stored one by one and merged, against the whole table.

    Quantiles are about right only: the share of rows at or below each must be near the one asked for.
    """
    lines = load(spark, sf, "lineitem").select(
        "l_extendedprice", "l_discount", "l_partkey", "l_returnflag"
    )
    path = scratch_path(spark, "sketches")
    for part in splits.hash_split_n(lines, (), [0.25, 0.25, 0.25], SEED):
        profile.column_sketches(part).write.mode("append").parquet(path)
    merged = profile.merge_sketches(spark.read.parquet(path))
    about = profile.sketched_quantiles(merged)
    ends = ("p25", "p50", "p75")
    numbers = ("l_extendedprice", "l_discount", "l_partkey")
    cut = {r["column"]: r for r in about.collect()}
    below = lines.agg(
        *(F.count_if(F.col(c) < cut[c][p]).alias(f"{c} {p} <") for c in numbers for p in ends),
        *(F.count_if(F.col(c) <= cut[c][p]).alias(f"{c} {p} <=") for c in numbers for p in ends),
        F.count("*").alias("n"),
    ).first()
    # Wide enough for a miss of the sketch to be very rare.
    slack = 4 * profile.SKETCH_ERROR / profile.SKETCH_SIZE**profile.SKETCH_POWER
    near = {
        c: all(
            below[f"{c} {p} <"] / below["n"] - slack <= share <= below[f"{c} {p} <="] / below["n"] + slack
            for p, share in zip(ends, profile.QUARTILES)
        )
        for c in numbers
    }
    flags = spark.createDataFrame(list(near.items()), "column STRING, near BOOLEAN")
    texts = ("min_text", "max_text")
    return merged.join(flags, "column", "left").select(
        "column", "n", *(_r(c, 4).alias(c) for c in ("mean", "stddev", "min", "max")), *texts, "near"
    )


# --- feature pipeline --------------------------------------------------------------------------


@query
def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = features.impute_mean(_prepared(spark, sf), ["n_lines", "sum_qty"])
    return df.select(
        "o_orderkey", "n_lines_IMPUTED", _r("sum_qty_IMPUTED").alias("sum_qty_IMPUTED")
    )


@query
def index_categories(spark: SparkSession, sf: str) -> DataFrame:
    columns = ORDER_SPEC.categorical
    df = features.index_categories(_prepared(spark, sf), columns)
    return df.select("o_orderkey", *(F.col(f"{c}_idx").cast("int").alias(f"{c}_idx") for c in columns))


def _unfolded(df: DataFrame, vector: str) -> DataFrame:
    """(key, slot, value) of the non-zero slots."""
    return df.select(
        "o_orderkey", F.posexplode(vector_to_array(vector)).alias("slot", "value")
    ).filter(F.col("value") != 0)


@query
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    df = features.one_hot(_prepared(spark, sf), ["o_orderpriority"])
    return _unfolded(df, "o_orderpriority_vec")


@query
def category_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """The values of three columns, one of them with a value per part."""
    return build_dictionary(
        load(spark, sf, "lineitem"), ["l_partkey", "l_returnflag", "l_linenumber"]
    ).table


@query
def dictionary_index(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary of one part of the orders, applied to all: values it has not seen come last."""
    df = _prepared(spark, sf)
    columns = [*ORDER_SPEC.categorical, "n_lines"]
    indexed = index_by_dictionary(df, build_dictionary(df.filter("label = 1"), columns))
    return indexed.select(
        "o_orderkey", *(F.col(f"{c}_idx").cast("int").alias(f"{c}_idx") for c in columns)
    )


@query
def dictionary_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    df = _prepared(spark, sf)
    made = build_dictionary(df, ["o_orderpriority", "n_lines"])
    encoded = one_hot_by_dictionary(df, made)
    return _unfolded(
        features.assemble(encoded, ["o_orderpriority_vec", "n_lines_vec"]), "features"
    )


@query
def assemble(spark: SparkSession, sf: str) -> DataFrame:
    lines = features.impute_mean(_prepared(spark, sf), ["n_lines", "sum_qty"])
    df = features.assemble(lines, ["sum_qty_IMPUTED", "n_lines_IMPUTED"])
    return _unfolded(df, "features").withColumn("value", _r("value"))


@query
def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    df = features.feature_frame(_prepared(spark, sf), ORDER_SPEC)
    return _unfolded(df, "features").withColumn("value", _r("value"))


@query
def feature_names(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_names(features.feature_frame(_prepared(spark, sf), ORDER_SPEC))


# --- estimators --------------------------------------------------------------------------------


# Lowest area under the curve that a sound fit of each algorithm reaches on the order table.
FLOORS = {
    "random_forest": 0.87, "gbt": 0.88, "linear_svm": 0.88, "logistic_regression": 0.88,
    "decision_tree": 0.83, "naive_bayes": 0.82,
}


def _fitted_scores(algorithm: str) -> Query:
    """Spark's defaults on all features: scores lie where they may, agree with the class and rank rows."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        inside, outside = _parts(spark, sf)
        scored = train(inside, ORDER_SPEC, algorithm, None, SEED).transform(outside)
        column = score_column(algorithm)
        score = class_score(column)
        has_chance = column == "probability"
        mirrored = F.abs(class_score(column, 0) + score - (1 if has_chance else 0)) < 1e-9
        sound = mirrored & (score.between(0, 1) if has_chance else ~F.isnan(score))
        auc = ev.area_under_roc(scored, column)
        return scored.select(
            "o_orderkey",
            "label",
            sound.alias("score_is_sound"),
            ((score > (0.5 if has_chance else 0)) == (F.col("prediction") == 1)).alias("class_agrees"),
            F.lit(auc >= FLOORS[algorithm]).alias("ranks_well"),
        )

    return run


def _stump_scores(algorithm: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        inside, outside = _parts(spark, sf)
        model = train(inside, TREE_SPEC, algorithm, STUMPS[algorithm], SEED)
        return _probabilities(model.transform(outside))

    return run


for _algorithm in ("random_forest", "gbt", "linear_svm", "logistic_regression", "decision_tree"):
    QUERIES[_algorithm] = _fitted_scores(_algorithm)
for _algorithm in STUMPS:
    QUERIES[f"{_algorithm}_stump"] = _stump_scores(_algorithm)


@query
def naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    return _probabilities(_nb_scored(spark, sf))


@query
def gbt_two_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """A second one-split tree fitted to what the first one leaves over."""
    inside, outside = _parts(spark, sf)
    model = train(inside, TREE_SPEC, "gbt", {"maxDepth": 1, "maxIter": 2}, SEED)
    return _probabilities(model.transform(outside))


@query
def second_order_stump(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = _parts(spark, sf)
    model = train(inside, TREE_SPEC, SECOND_ORDER, {"maxDepth": 1, "maxIter": 1}, SEED)
    return _probabilities(model.transform(outside))


@query
def second_order_two_rounds(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = _parts(spark, sf)
    model = train(inside, TREE_SPEC, SECOND_ORDER, {"maxDepth": 1, "maxIter": 2}, SEED)
    return _probabilities(model.transform(outside))


@query
def second_order(spark: SparkSession, sf: str) -> DataFrame:
    """Second-order trees on all columns: sound scores that rank at least as well as boosted trees do."""
    inside, outside = _parts(spark, sf)
    params = {"maxDepth": 4, "maxIter": 8, "stepSize": 0.4}
    scored = train(inside, ORDER_SPEC, SECOND_ORDER, params, SEED).transform(outside)
    chance = class_score("probability")
    auc = ev.area_under_roc(scored)
    return scored.select(
        "o_orderkey",
        "label",
        (chance.between(0, 1) & (F.abs(class_score("probability", 0) + chance - 1) < 1e-9)).alias("score_is_sound"),
        ((chance > 0.5) == (F.col("prediction") == 1)).alias("class_agrees"),
        F.lit(auc >= FLOORS["gbt"]).alias("ranks_well"),
    )


def _validated(spark: SparkSession, sf: str, algorithm: str) -> DataFrame:
    """Losses of two rounds on the rows that learn and on those that say when to stop."""
    inside, _ = _parts(spark, sf)
    model = train(
        inside, TREE_SPEC, algorithm, {"maxDepth": 1, "maxIter": 2}, SEED, validation_rate=0.2
    )
    marked = marked_for_validation(inside, TREE_SPEC, 0.2, SEED)
    parts = {"train": marked.filter(~F.col(VALIDATION)), "validation": marked.filter(F.col(VALIDATION))}
    return round_losses(model, parts).withColumn("loss", _r("loss"))


@query
def gbt_round_losses(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf, "gbt")


@query
def second_order_round_losses(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf, SECOND_ORDER)


@query
def logistic_regression_totals(spark: SparkSession, sf: str) -> DataFrame:
    """At the optimum, predicted and actual positives agree within every category."""
    inside, _ = _parts(spark, sf)
    model = train(inside, ORDER_SPEC, "logistic_regression", {"tol": 1e-10}, SEED)
    long = model.transform(inside).select(
        F.explode(F.array(*ORDER_SPEC.categorical)).alias("category"),
        class_score("probability").alias("p"),
    )
    return long.groupBy("category").agg(
        F.count("*").alias("n"), _r(F.avg("p"), 4).alias("positive_rate")
    )


def _banded(spark: SparkSession, sf: str) -> DataFrame:
    """The prepared table with its quantities in five bands, as a category."""
    band = F.least(F.floor(F.coalesce(F.col("sum_qty"), F.lit(0.0)) / 40), F.lit(4))
    df = _prepared(spark, sf).withColumn("qty_band", band)
    return prepare.as_category(df, ["qty_band"])


@query
def logistic_regression_groups(spark: SparkSession, sf: str) -> DataFrame:
    """On one category alone, the probability is the category's share of positives."""
    inside, outside = _stored_bands(spark, sf)
    model = train(inside, BAND_SPEC, "logistic_regression", {"tol": 1e-10}, SEED)
    return model.transform(outside).select(
        "o_orderkey", _r(class_score("probability"), 5).alias("p1")
    )


def _board(table: DataFrame, floor: float) -> DataFrame:
    """A leaderboard in terms that do not hang on a fit: places, order and bounds of the metrics."""
    rows = table.collect()
    areas = [r["auc"] for r in rows]
    out = [
        (
            r["rank"],
            r["status"],
            r["auc"] >= floor,
            r["rank"] == 1 or areas[r["rank"] - 2] >= r["auc"],
            0 < r["log_loss"] < 0.7 and 0 < r["mean_per_class_error"] < 0.4,
            len({(x["algorithm"], x["params"]) for x in rows}),
        )
        for r in rows
    ]
    kind = "rank INT, status STRING, good BOOLEAN, in_order BOOLEAN, in_bounds BOOLEAN, candidates INT"
    return table.sparkSession.createDataFrame(out, kind)


@query
def auto_search(spark: SparkSession, sf: str) -> DataFrame:
    """Five models over five folds, from three algorithms."""
    found = selection.auto_search(
        _parts(spark, sf)[0], ORDER_SPEC, max_runtime_secs=None,
        algorithms=("gbt", "random_forest", "logistic_regression"),
    )
    return _board(selection.leaderboard(found), 0.85)


@query
def search_with_early_stopping(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees whose rounds a share of the rows ends before their maximum."""
    candidates = [selection.Candidate("gbt", {"maxIter": 30, "maxDepth": 4, "stepSize": 1.0})]
    found = selection.search(
        _parts(spark, sf)[0], ORDER_SPEC, candidates, folds=2, seed=SEED, validation_rate=0.2
    )
    rounds = selection.rounds_table(found)
    return rounds.select("candidate", "algorithm", "fold", F.col("rounds").between(1, 29).alias("stopped"))


@query
def search_with_a_limit(spark: SparkSession, sf: str) -> DataFrame:
    """A candidate that would take many minutes is cancelled while it is fitted; the session goes on."""
    candidates = [
        selection.Candidate("naive_bayes"),
        selection.Candidate("gbt", {"maxIter": 2000, "maxDepth": 5}),
    ]
    found = selection.search(
        _parts(spark, sf)[0], ORDER_SPEC, candidates, FOLDS, SEED, max_candidate_secs=8.0
    )
    board = selection.leaderboard(found)
    return board.select("rank", "candidate", "algorithm", "status", _r("auc").alias("auc"))


@query
def auto_search_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    found = selection.auto_search(
        _parts(spark, sf)[0], ORDER_SPEC, max_runtime_secs=None, algorithms=("naive_bayes",)
    )
    table = selection.leaderboard(found)
    return table.select("rank", "algorithm", "params", _r("auc").alias("auc"))


# --- model selection ---------------------------------------------------------------------------


def _nb_search(spark: SparkSession, sf: str, smoothings=SMOOTHINGS) -> selection.SearchResult:
    grid = {"smoothing": smoothings}
    return selection.cross_validate(
        _parts(spark, sf)[0], ORDER_SPEC, "naive_bayes", grid, FOLDS, SEED
    )


@query
def cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    table = selection.fold_metrics(_nb_search(spark, sf, (1.0,)))
    return table.withColumn("value", _r("value"))


# The grid of the tuned job.
FOREST_GRID = {"maxDepth": (3, 5, 7), "numTrees": (50, 100, 200)}


@query
def param_grid(spark: SparkSession, sf: str) -> DataFrame:
    """A grid of forests tuned on the order table: every combination, and whether its metric is sound."""
    found = selection.cross_validate(
        _parts(spark, sf)[0], ORDER_SPEC, "random_forest", FOREST_GRID, FOLDS, SEED
    )
    table = selection.cv_summary(found)
    return table.select(
        "candidate",
        "algorithm",
        "params",
        F.col("mean_auc").between(0.8, 1).alias("good"),
        F.col("stddev_auc").between(1e-9, 0.1).alias("folds_differ"),
    )


@query
def best_params(spark: SparkSession, sf: str) -> DataFrame:
    chosen = selection.best_params(_nb_search(spark, sf))
    return spark.createDataFrame(
        [(name, float(value)) for name, value in chosen.items()], "name STRING, value DOUBLE"
    )


@query
def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    table = selection.cv_summary(_nb_search(spark, sf))
    return table.select(
        "candidate", "algorithm", "params",
        _r("mean_auc").alias("mean_auc"), _r("stddev_auc").alias("stddev_auc"),
    )


@query
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    table = selection.leaderboard(_nb_search(spark, sf))
    return table.withColumns({c: _r(c) for c in ("auc", "log_loss", "mean_per_class_error")})


@query
def leader_params(spark: SparkSession, sf: str) -> DataFrame:
    return selection.params_table(spark, selection.leader(_nb_search(spark, sf)))


@query
def oof_predictions(spark: SparkSession, sf: str) -> DataFrame:
    inside = _parts(spark, sf)[0]
    found = selection.cross_validate(inside, ORDER_SPEC, "naive_bayes", None, FOLDS, SEED)
    scored = selection.oof_predictions(inside, ORDER_SPEC, found.best.models, SEED)
    return scored.select(
        "o_orderkey", "fold", "label", _r(class_score("probability")).alias("p1")
    )


@query
def compare(spark: SparkSession, sf: str) -> DataFrame:
    """All six at Spark's defaults, on a validation and a test part."""
    numbered = splits.hash_split_n(_prepared(spark, sf), KEY, [0.6, 0.2], SEED)
    parts = dict(zip(("train", "validation", "test"), numbered))
    rows = selection.compare(parts, ORDER_SPEC, list(CLASSIFIERS), seed=SEED).collect()
    return spark.createDataFrame(
        [
            (
                r["algorithm"],
                r["part"],
                r["auc"] >= FLOORS[r["algorithm"]] - 0.02,
                0.7 <= r["accuracy"] <= 1 and 0 <= r["mean_per_class_error"] <= 0.35,
            )
            for r in rows
        ],
        "algorithm STRING, part STRING, ranks_well BOOLEAN, classes_well BOOLEAN",
    )


@query
def compare_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    """Train on one part, report on the two others."""
    numbered = splits.hash_split_n(_prepared(spark, sf), KEY, [0.5, 0.25], SEED)
    parts = dict(zip(("train", "validation", "test"), numbered))
    table = selection.compare(parts, ORDER_SPEC, ["naive_bayes"], seed=SEED)
    return table.select(
        "algorithm", "part", *(_r(c).alias(c) for c in ("auc", "accuracy", "mean_per_class_error"))
    )


# --- scoring and evaluation --------------------------------------------------------------------


@query
def score(spark: SparkSession, sf: str) -> DataFrame:
    model, inside, _ = _nb(spark, sf)
    return _probabilities(scoring.score(model, inside))


@query
def area_under_roc(spark: SparkSession, sf: str) -> DataFrame:
    scored = _nb_scored(spark, sf)
    return _value_row(scored, auc=ev.area_under_roc(scored))


@query
def area_by_group(spark: SparkSession, sf: str) -> DataFrame:
    table = ev.area_by_group(_nb_scored(spark, sf), ["o_orderpriority"])
    return table.withColumn("auc", _r("auc"))


@query
def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    return ev.log_loss(_nb_scored(spark, sf)).select(_r("log_loss").alias("log_loss"))


@query
def mean_per_class_error(spark: SparkSession, sf: str) -> DataFrame:
    table = ev.mean_per_class_error(_nb_scored(spark, sf))
    return table.select(_r("mean_per_class_error").alias("mean_per_class_error"))


@query
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(_nb_scored(spark, sf))


@query
def confusion_matrix_max_f1(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(_nb_scored(spark, sf), "max_f1")


@query
def score_table(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    return scoring.score_table(model, outside, KEY).select(
        "o_orderkey",
        _r(class_score("rawPrediction", 0)).alias("raw0"),
        _r(class_score("rawPrediction", 1)).alias("raw1"),
        _r(class_score("probability", 0)).alias("p0"),
        _r(class_score("probability", 1)).alias("p1"),
        "prediction",
        _r("prob", 5).alias("prob"),
    )


@query
def class_table(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    table = scoring.score_table(model, outside, form="classes")
    return table.withColumn("p0", _r("p0")).withColumn("p1", _r("p1"))


def _rounded_performance(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {c: _r(c) for c in ("accuracy", "mean_per_class_error", "log_loss", "auc")}
    )


@query
def performance_bundle(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = _stored_parts(spark, sf)
    model = train(inside, ORDER_SPEC, "naive_bayes", seed=SEED)
    found = selection.cross_validate(inside, ORDER_SPEC, "naive_bayes", None, FOLDS, SEED)
    parts = {
        "train": model.transform(inside),
        "cv": selection.oof_predictions(inside, ORDER_SPEC, found.best.models, SEED),
        "holdout": model.transform(outside),
    }
    return _rounded_performance(ev.performance_bundle(parts))


def _ranking(spark: SparkSession, sf: str) -> ev.RankingReport:
    model, inside, outside = _nb(spark, sf)
    return ev.ranking_report({"train": model.transform(inside), "holdout": model.transform(outside)})


@query
def ranking_areas(spark: SparkSession, sf: str) -> DataFrame:
    table = _ranking(spark, sf).areas
    return table.select("part", _r("auc").alias("auc"), _r("auc_pr").alias("auc_pr"))


@query
def best_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    table = _ranking(spark, sf).thresholds
    return table.select("part", "criterion", _r("threshold").alias("threshold"), _r("value").alias("value"))


@query
def gains_lift(spark: SparkSession, sf: str) -> DataFrame:
    table = _ranking(spark, sf).gains
    rounded = [c for c in table.columns if c not in ("part", "group", "n")]
    return table.select("part", "group", "n", *(_r(c).alias(c) for c in rounded))


@query
def cv_metrics_summary(spark: SparkSession, sf: str) -> DataFrame:
    inside = _stored_parts(spark, sf)[0]
    found = selection.cross_validate(inside, ORDER_SPEC, "naive_bayes", None, FOLDS, SEED)
    oof = selection.oof_predictions(inside, ORDER_SPEC, found.best.models, SEED)
    table = ev.cv_metrics_summary(oof)
    return table.withColumns({c: _r(c) for c in ("value", "mean", "stddev")})


@query
def svm_area_under_roc(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluator's area by raw score against the rank sum over ranges, 100 iterations."""
    inside, outside = _parts(spark, sf)
    scored = train(inside, ORDER_SPEC, "linear_svm", {"maxIter": 100}, SEED).transform(outside)
    area = ev.area_under_roc(scored, "rawPrediction")
    tagged = scored.withColumn("all", F.lit(0))
    ranked = ev.area_by_group(tagged, ["all"], "rawPrediction")
    return ranked.join(tagged.groupBy("all").count(), "all").select(
        F.col("count").alias("n"),
        (F.abs(F.col("auc") - area) < 1e-9).alias("areas_agree"),
        (F.col("auc") >= FLOORS["linear_svm"]).alias("ranks_well"),
    )


@query
def linear_svm_groups(spark: SparkSession, sf: str) -> DataFrame:
    """On one category alone, the class is the category's majority."""
    inside, outside = _stored_bands(spark, sf)
    model = train(inside, BAND_SPEC, "linear_svm", None, SEED)
    return model.transform(outside).select("o_orderkey", F.col("prediction").cast("int").alias("prediction"))


@query
def performance_at_max_f1(spark: SparkSession, sf: str) -> DataFrame:
    model, _, outside = _nb(spark, sf)
    table = ev.performance_bundle({"holdout": model.transform(outside)}, max_f1=True)
    return table.select("part", "n", "tp", "fn", "fp", "tn", _r("auc").alias("auc"))


# --- interpretation ----------------------------------------------------------------------------


def _two_levels(spark: SparkSession, sf: str) -> tuple[PipelineModel, DataFrame]:
    inside, outside = _parts(spark, sf)
    return train(inside, TREE_SPEC, "decision_tree", {"maxDepth": 2}, SEED), outside


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    table = explain.feature_importance(*_two_levels(spark, sf))
    return table.select("name", _r("score").alias("score"))


@query
def variable_importance(spark: SparkSession, sf: str) -> DataFrame:
    table = explain.variable_importance(*_two_levels(spark, sf))
    return table.select("variable", *(_r(c).alias(c) for c in table.columns[1:]))


@query
def forest_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Every slot once, none below zero, and all of them adding up to one."""
    inside, outside = _parts(spark, sf)
    table = explain.feature_importance(train(inside, ORDER_SPEC, "random_forest", seed=SEED), outside)
    total = table.agg(F.sum("score")).first()[0]
    return table.select(
        "name", F.col("score").between(0, 1).alias("sound"), _r(F.lit(total)).alias("total")
    )


def _rounded_contributions(table: DataFrame) -> DataFrame:
    return table.withColumn("contribution", _r("contribution"))


@query
def linear_contributions(spark: SparkSession, sf: str) -> DataFrame:
    model, inside, outside = _nb(spark, sf)
    return _rounded_contributions(explain.contributions(model, outside, ORDER_SPEC, inside))


@query
def logistic_contributions(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = _stored_bands(spark, sf)
    model = train(inside, BAND_SPEC, "logistic_regression", {"tol": 1e-10}, SEED)
    table = explain.contributions(model, outside, BAND_SPEC, inside)
    return table.withColumn("contribution", _r("contribution", 4))


@query
def tree_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """Exact Shapley values of a one-split tree."""
    inside, outside = _parts(spark, sf)
    model = train(inside, TREE_SPEC, "decision_tree", STUMPS["decision_tree"], SEED)
    return _rounded_contributions(explain.contributions(model, outside, TREE_SPEC))


def _gaps(model: PipelineModel, df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per row, its number of contributions and what they miss of the output's distance from the base."""
    parts = explain.contributions(model, df, spec)
    point = explain.reference_row(model, df)
    base = df.limit(1).select(
        *(
            F.lit(point[c]).cast(df.schema[c].dataType).alias(c)
            for c in (*spec.categorical, *spec.numeric)
        )
    )
    start = model.transform(base).select(explain.model_output(model).alias("v")).first()["v"]
    outputs = model.transform(df).select(*spec.key, explain.model_output(model).alias("output"))
    summed = parts.groupBy(*spec.key).agg(
        F.count("*").alias("n"), F.sum("contribution").alias("sum")
    )
    gap = F.col("sum") - (F.col("output") - F.lit(start))
    return summed.join(outputs, list(spec.key)).select(*spec.key, "n", _r(gap).alias("gap"))


@query
def boosted_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees at Spark's defaults: exact contributions add up row by row."""
    inside, outside = _parts(spark, sf)
    return _gaps(train(inside, ORDER_SPEC, "gbt", seed=SEED), outside, ORDER_SPEC)


WIDE_SPEC = ORDER_SPEC.using(
    categorical=("o_orderstatus", "o_orderpriority", "c_mktsegment", "nation"),
    numeric=("n_lines", "sum_qty", "c_acctbal", "o_totalprice"),
    dropped=(),
)


@query
def wide_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """A forest over eight columns."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    nations = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("string").alias("nation")
    )
    more = orders.join(nations, "o_custkey").drop("o_custkey")
    df = prepare.prepare(order_profile(spark, sf).join(more, "o_orderkey"), WIDE_SPEC)
    inside, outside = splits.hash_split(df, KEY, RATE, SEED)
    return _gaps(train(inside, WIDE_SPEC, "random_forest", seed=SEED), outside, WIDE_SPEC)


@query
def path_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """A one-split tree by cover: the split's column moves the row from the mean to its leaf."""
    inside, outside = _parts(spark, sf)
    model = train(inside, TREE_SPEC, "decision_tree", STUMPS["decision_tree"], SEED)
    return _rounded_contributions(explain.contributions(model, outside, TREE_SPEC, method="path"))


def _two_rounds(spark: SparkSession, sf: str) -> DataFrame:
    inside, outside = _parts(spark, sf)
    model = train(inside, TREE_SPEC, "gbt", {"maxDepth": 1, "maxIter": 2}, SEED)
    return explain.contributions(model, outside, TREE_SPEC, method="path")


@query
def boosted_path_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """Log-odds of two boosted one-split trees, with where they start from."""
    return _rounded_contributions(_two_rounds(spark, sf))


@query
def path_summary(spark: SparkSession, sf: str) -> DataFrame:
    return explain.contribution_summary(_two_rounds(spark, sf)).withColumn(
        "mean_abs_contribution", _r("mean_abs_contribution")
    )


@query
def path_additivity(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees at Spark's defaults: all rows of a key add up to its log-odds."""
    inside, outside = _stored_parts(spark, sf)
    model = train(inside, ORDER_SPEC, "gbt", seed=SEED)
    parts = explain.contributions(model, outside, ORDER_SPEC, method="path")
    summed = parts.groupBy(*KEY).agg(F.count("*").alias("n"), F.sum("contribution").alias("sum"))
    outputs = model.transform(outside).select(*KEY, explain.model_output(model).alias("output"))
    return summed.join(outputs, list(KEY)).select(*KEY, "n", _r(F.col("sum") - F.col("output")).alias("gap"))


@query
def explain_row(spark: SparkSession, sf: str) -> DataFrame:
    model, inside, _ = _nb(spark, sf)
    df = _prepared(spark, sf)
    return _rounded_contributions(explain.explain_row(model, df, ORDER_SPEC, (7,), inside))


@query
def contribution_summary(spark: SparkSession, sf: str) -> DataFrame:
    model, inside, outside = _nb(spark, sf)
    table = explain.contributions(model, outside, ORDER_SPEC, inside)
    return explain.contribution_summary(table).withColumn(
        "mean_abs_contribution", _r("mean_abs_contribution")
    )


# --- jobs --------------------------------------------------------------------------------------


def _profile_text(spark: SparkSession, sf: str) -> str:
    """The order table as headerless text, a blank after every separator."""
    path = scratch_path(spark, "profile-text")
    df = order_profile(spark, sf)
    fields = [
        F.concat(F.lit("" if position == 0 else " "), F.coalesce(F.col(c).cast("string"), F.lit("")))
        for position, c in enumerate(df.columns)
    ]
    df.select(F.concat_ws(",", *fields)).write.text(path)
    return path


@query
def train_job(spark: SparkSession, sf: str) -> DataFrame:
    spec = JobSpec(TEXT_SPEC, "naive_bayes")
    report = jobs.train_job(spark, spec, _profile_text(spark, sf), scratch_path(spark, "model"))
    counts = report.counts.select(
        F.concat_ws(" ", "part", F.col("label").cast("string")).alias("name"),
        F.col("count").cast("double").alias("value"),
    )
    auc = _value_row(counts, auc=report.auc)
    return counts.unionByName(auc.select(F.lit("auc").alias("name"), F.col("auc").alias("value")))


@query
def tune_job(spark: SparkSession, sf: str) -> DataFrame:
    spec = JobSpec(TEXT_SPEC, "random_forest", grid=FOREST_GRID)
    report = jobs.tune_job(spark, spec, _profile_text(spark, sf), scratch_path(spark, "model"))
    return _board(selection.leaderboard(report.search), 0.8)


@query
def job_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """What the stored model of a job says about its settings, and the rows that its rate left it."""
    spec = JobSpec(
        TEXT_SPEC, "random_forest", train_rate=0.5, seed=7, max_depth=4,
        params={"numTrees": 9, "subsamplingRate": 0.75},
    )
    report = jobs.train_job(spark, spec, _profile_text(spark, sf), scratch_path(spark, "model"))
    told = selection.params_table(spark, report.model)
    told = told.filter(F.col("name").isin("maxDepth", "numTrees", "seed", "subsamplingRate"))
    sizes = report.counts.groupBy("part").agg(F.sum("count").cast("string").alias("value"))
    return told.unionAll(sizes.select(F.col("part").alias("name"), "value"))


@query
def tune_job_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    spec = JobSpec(TEXT_SPEC, "naive_bayes", grid={"smoothing": SMOOTHINGS})
    report = jobs.tune_job(spark, spec, _profile_text(spark, sf), scratch_path(spark, "model"))
    chosen = selection.best_params(report.search)["smoothing"]
    table = _value_row(report.counts, auc=report.auc, cv_auc=report.search.best.mean)
    return table.withColumn("smoothing", F.lit(float(chosen)))


@query
def automl_job(spark: SparkSession, sf: str) -> DataFrame:
    """Five boosted models over five folds."""
    spec = JobSpec(TEXT_SPEC, max_runtime_secs=None)
    report = jobs.automl_job(spark, spec, _profile_text(spark, sf), scratch_path(spark, "model"))
    cells = F.col("tp") + F.col("fn") + F.col("fp") + F.col("tn")
    return report.performance.select(
        "part",
        "n",
        (F.col("tp") + F.col("fn")).alias("positives"),
        (cells == F.col("n")).alias("cells_add_up"),
        (F.col("auc") >= 0.85).alias("ranks_well"),
        F.col("log_loss").between(0.05, 0.6).alias("loss_is_sound"),
    )


@query
def automl_job_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    spec = JobSpec(TEXT_SPEC, max_runtime_secs=None, algorithms=("naive_bayes",))
    report = jobs.automl_job(spark, spec, _profile_text(spark, sf), scratch_path(spark, "model"))
    return _rounded_performance(report.performance)


@query
def predict_job(spark: SparkSession, sf: str) -> DataFrame:
    spec = JobSpec(TEXT_SPEC, "naive_bayes")
    model, _, _ = _nb(spark, sf)
    stored, text = scratch_path(spark, "model"), _labelless_text(spark, sf)
    save_model(model, stored)
    raw = jobs.predict_job(
        spark, spec.using(table=_trimmed_spec()), text, stored, scratch_path(spark, "scores")
    )
    return _probabilities(raw)


@query
def score_new_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops of files, each scored when it comes, and a run that finds nothing new."""
    model, _, _ = _nb(spark, sf)
    stored, text = scratch_path(spark, "model"), scratch_path(spark, "drops")
    save_model(model, stored)
    whole = spark.read.text(_labelless_text(spark, sf))
    out, progress = scratch_path(spark, "scores"), scratch_path(spark, "progress")
    spec = JobSpec(_trimmed_spec(), "naive_bayes")
    n_rows = []
    for drop in splits.hash_split(whole, ("value",), 0.5, SEED):
        drop.write.mode("append").text(text)
        n_rows.append(jobs.score_new_files(spark, spec, text, stored, out, progress))
    n_rows.append(jobs.score_new_files(spark, spec, text, stored, out, progress))
    scores = read_scores(spark, out)
    return _probabilities(scores).withColumn("rows_seen", F.lit(sum(n_rows)).cast("long")).withColumn(
        "idle_rows", F.lit(n_rows[-1]).cast("long")
    )


@query
def svm_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """The curve of out-of-fold margins: at its best, chances add up to the positives it was fitted on."""
    inside, _ = _parts(spark, sf)
    folded = splits.assign_fold(inside, KEY, 3, SEED, selection.FOLD)
    quick = [selection.Candidate("linear_svm", {"maxIter": 10})]
    found = selection.search(inside, ORDER_SPEC, quick, folds=3, seed=SEED)
    held_out = selection.held_out_predictions(folded, found.best.models)
    curve = calibrate.fitted_curve(ev.score_points(held_out, class_score("rawPrediction")))
    scored = curve.transform(held_out)
    return scored.agg(
        F.count("*").alias("n"),
        _r(F.avg("label"), 4).alias("positive_rate"),
        _r(F.avg(class_score("probability")), 4).alias("mean_chance"),
    )


@query
def predict_job_svm(spark: SparkSession, sf: str) -> DataFrame:
    """A stored SVM scores a table: chances lie between 0 and 1 and rise with the margin."""
    spec = JobSpec(TEXT_SPEC, "linear_svm", params={"maxIter": 10}, folds=2)
    text, model_path = _profile_text(spark, sf), scratch_path(spark, "model")
    report = jobs.train_job(spark, spec, text, model_path)
    curve = report.model.stages[-1]
    scores = jobs.predict_job(spark, spec, text, model_path, scratch_path(spark, "scores"))
    chance = class_score("probability")
    odds = class_score("rawPrediction") * curve.getOrDefault("slope") + curve.getOrDefault("intercept")
    return scores.select(
        "o_orderkey",
        chance.between(0, 1).alias("in_bounds"),
        (F.abs(F.ln(chance / (1 - chance)) - odds) < 1e-6).alias("by_margin"),
        F.lit(curve.getOrDefault("slope") > 0).alias("rises"),
        F.lit(report.auc >= FLOORS["linear_svm"]).alias("ranks_well"),
    )


@query
def predict_job_without_key(spark: SparkSession, sf: str) -> DataFrame:
    """A table without a key: the scores come with the input columns."""
    table = _trimmed_spec().using(key=())
    model, _, _ = _nb(spark, sf)
    stored, text = scratch_path(spark, "model"), _labelless_text(spark, sf)
    save_model(model, stored)
    raw = jobs.predict_job(
        spark, JobSpec(table, "naive_bayes"), text, stored, scratch_path(spark, "scores")
    )
    return raw.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment", "n_lines",
        _r("sum_qty").alias("sum_qty"), _r(class_score("probability")).alias("p1"),
    )


def _trimmed_spec() -> TableSpec:
    return ORDER_SPEC.using(
        schema=(
            "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING, "
            "c_mktsegment STRING, n_lines INT, sum_qty DOUBLE"
        ),
        dropped=(),
        label_source=None,
    )


def _labelless_text(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "unlabelled")
    order_profile(spark, sf).drop("c_acctbal", "revenue_band").write.csv(path)
    return path


@query
def train_and_score(spark: SparkSession, sf: str) -> DataFrame:
    spec = JobSpec(TEXT_SPEC, "naive_bayes")
    text = _profile_text(spark, sf)
    _, scores = jobs.train_and_score(
        spark, spec, text, text, scratch_path(spark, "model"), scratch_path(spark, "scores")
    )
    return _probabilities(scores)
