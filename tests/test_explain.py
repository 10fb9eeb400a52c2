import pickle
from itertools import permutations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrove.functions.expressions import class_score
from tallygrove.operators import explain
from tallygrove.operators.classifiers import train
from tallygrove.operators.splits import hash_split
from tallygrove.plans.fixtures import ORDER_SPEC

SPEC = ORDER_SPEC.using(categorical=("o_orderpriority",))


@pytest.fixture(scope="module")
def boosted(orders):
    inside, outside = hash_split(orders, SPEC.key)
    return train(inside, SPEC, "gbt", {"maxIter": 3, "maxDepth": 3}), outside


def output_of(model, df):
    scored = model.transform(df).select("o_orderkey", explain.model_output(model).alias("v"))
    return {r["o_orderkey"]: r["v"] for r in scored.collect()}


def by_key(table):
    out = {}
    for r in table.collect():
        out.setdefault(r["o_orderkey"], {})[r["feature"]] = r["contribution"]
    return out


def test_importances_add_up(boosted):
    model, outside = boosted
    rows = explain.feature_importance(model, outside).collect()
    scores = [r["score"] for r in rows]
    assert sum(scores) == pytest.approx(1.0)
    assert scores == sorted(scores, reverse=True)
    top = explain.variable_importance(model, outside).first()
    assert top["scaled_importance"] == 1.0
    assert top["percentage"] == pytest.approx(top["relative_importance"])


def test_exact_shapley_against_all_orders(spark, boosted):
    model, outside = boosted
    row = outside.filter(F.col("n_lines") > 5).orderBy("o_orderkey").first()
    point = explain.reference_row(model, outside)
    columns = [*SPEC.categorical, *SPEC.numeric]

    def value(taken):
        mixed = {c: row[c] if c in taken else point[c] for c in columns}
        one = spark.createDataFrame([(0, *mixed.values())], outside.select("o_orderkey", *columns).schema)
        return output_of(model, one)[0]

    from functools import cache
    value = cache(value)
    want = dict.fromkeys(columns, 0.0)
    orders_of = list(permutations(columns))
    for order in orders_of:
        taken = frozenset()
        for c in order:
            want[c] += (value(taken | {c}) - value(taken)) / len(orders_of)
            taken |= {c}
    got = by_key(explain.contributions(model, outside.filter(F.col("o_orderkey") == row["o_orderkey"]), SPEC))
    assert got[row["o_orderkey"]] == pytest.approx(want, abs=1e-9)


WIDE = ORDER_SPEC.using(
    categorical=("o_orderstatus", "o_orderpriority", "c_mktsegment", "weekday"),
    numeric=("n_lines", "sum_qty", "digit", "half"),
)


def widened(df):
    return df.withColumns(
        {
            "weekday": F.concat(F.lit("d"), (F.col("o_orderkey") % 7).cast("string")),
            "digit": F.col("o_orderkey") % 10,
            "half": F.when(F.col("o_orderkey") % 3 > 0, F.col("sum_qty") / 2),
        }
    )


def exchanges(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join"), (
        df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    )


def base_output(spark, model, df, spec):
    point = explain.reference_row(model, df)
    columns = [*spec.categorical, *spec.numeric]
    schema = df.select("o_orderkey", *columns).schema
    row = spark.createDataFrame([(0, *(point[c] for c in columns))], schema)
    return output_of(model, row)[0]


@pytest.mark.parametrize(
    "algorithm, params",
    [
        ("decision_tree", {"maxDepth": 6}),
        ("random_forest", {"numTrees": 7}),
        ("gbt", {"maxIter": 6, "maxDepth": 4}),
    ],
)
def test_tree_contributions_of_a_wide_table_add_up(spark, orders, algorithm, params):
    inside, outside = hash_split(widened(orders), WIDE.key)
    model = train(inside, WIDE, algorithm, params)
    # A value that training did not see, and nulls.
    odd = outside.withColumns(
        {"weekday": F.when(F.col("o_orderkey") % 5 > 0, F.lit("never")), "n_lines": F.lit(None).cast("int")}
    )
    for rows in (outside, odd):
        explained = explain.contributions(model, rows, WIDE)
        assert exchanges(explained) == exchanges(rows)
        got, outputs = by_key(explained), output_of(model, rows)
        base = base_output(spark, model, rows, WIDE)
        assert got.keys() == outputs.keys()
        for key, parts in got.items():
            assert len(parts) == 8
            assert sum(parts.values()) == pytest.approx(outputs[key] - base, abs=1e-9)


def test_rows_without_a_key_or_with_a_repeated_one(boosted):
    model, outside = boosted
    n = outside.count()
    keyless = explain.contributions(model, outside, SPEC.using(key=()))
    assert keyless.count() == 3 * n and keyless.columns == ["feature", "contribution"]
    one = by_key(explain.contributions(model, outside, SPEC))
    twice = explain.contributions(model, outside.unionAll(outside), SPEC).collect()
    assert len(twice) == 6 * n
    assert all(r["contribution"] == one[r["o_orderkey"]][r["feature"]] for r in twice)
    with pytest.raises(ValueError):
        explain.explain_row(model, outside, SPEC.using(key=()), (1,))
    row = outside.filter("n_lines is not null").first()
    chosen = {c: row[c] for c in ("o_orderkey", "n_lines")}
    by_values = explain.explain_row(model, outside, SPEC.using(key=()), chosen)
    by_condition = explain.explain_row(
        model, outside, SPEC.using(key=()), F.col("o_orderkey") == row["o_orderkey"]
    )
    assert by_values.collect() == by_condition.collect()
    assert by_values.count() == 3


@pytest.mark.parametrize("kind", ["gaussian", "bernoulli", "complement"])
def test_naive_bayes_kinds_add_up(orders, kind):
    spec = ORDER_SPEC.using(numeric=()) if kind == "bernoulli" else ORDER_SPEC
    frame = orders.withColumn("n_lines", F.col("n_lines") - 4) if kind == "gaussian" else orders
    inside, outside = hash_split(frame, spec.key)
    model = train(inside, spec, "naive_bayes", {"modelType": kind})
    got = by_key(explain.contributions(model, outside, spec))
    margin = class_score("rawPrediction") - class_score("rawPrediction", 0)
    rows = model.transform(outside).select("o_orderkey", margin.alias("m")).collect()
    mean = sum(r["m"] for r in rows) / len(rows)
    for r in rows:
        assert sum(got[r["o_orderkey"]].values()) == pytest.approx(r["m"] - mean, rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("algorithm", ["naive_bayes", "logistic_regression", "linear_svm"])
def test_linear_contributions_add_up(orders, algorithm):
    inside, outside = hash_split(orders, ORDER_SPEC.key)
    params = {"linear_svm": {"maxIter": 10}}.get(algorithm)
    model = train(inside, ORDER_SPEC, algorithm, params)
    got = by_key(explain.contributions(model, outside, ORDER_SPEC))
    raw = class_score("rawPrediction")
    margin = raw - class_score("rawPrediction", 0) if algorithm == "naive_bayes" else raw
    rows = model.transform(outside).select("o_orderkey", margin.alias("m")).collect()
    mean = sum(r["m"] for r in rows) / len(rows)
    for r in rows:
        assert sum(got[r["o_orderkey"]].values()) == pytest.approx(r["m"] - mean, abs=1e-6)


def test_one_row_is_ordered_by_size(scored):
    model, inside, outside, _ = scored
    key = outside.orderBy("o_orderkey").first()["o_orderkey"]
    rows = explain.explain_row(model, outside, ORDER_SPEC, (key,), inside).collect()
    assert {r["o_orderkey"] for r in rows} == {key}
    sizes = [abs(r["contribution"]) for r in rows]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) == 5
    summary = explain.contribution_summary(explain.contributions(model, outside, ORDER_SPEC))
    assert summary.count() == 5


def by_cover(model, df, spec, row):
    """Shapley values by the definition: walk the saved trees for every subset of columns."""
    fitted, columns = model.stages[-1], [*spec.categorical, *spec.numeric]
    boosted = hasattr(fitted, "treeWeights") and fitted.__class__.__name__.startswith("GBT")
    nodes = {(r["tree"], r["id"]): r for r in explain.tree_nodes(fitted, df.sparkSession).collect()}
    weights = fitted.treeWeights if boosted else [1 / len(getattr(fitted, "trees", [0]))] * len(getattr(fitted, "trees", [0]))
    stages = model.copy()
    stages.stages = model.stages[:-1]
    features = stages.transform(df)
    vector = features.filter(F.col("o_orderkey") == row["o_orderkey"]).first()["features"].toArray()
    source_of = dict(explain.slot_sources(features, spec))

    def size(node):
        return node["impurityStats"][0] if boosted else sum(node["impurityStats"])

    def value(tree, node, taken):
        if node["leftChild"] < 0:
            if boosted:
                return 2 * node["prediction"]
            return node["impurityStats"][1] / size(node)
        children = [nodes[tree, node["leftChild"]], nodes[tree, node["rightChild"]]]
        slot, cuts = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"]
        if source_of[slot] not in taken:
            return sum(size(c) * value(tree, c, taken) for c in children) / size(node)
        x = vector[slot]
        left = x <= cuts[0] if node["split"]["numCategories"] == -1 else x in cuts
        return value(tree, children[0 if left else 1], taken)

    def game(taken):
        return sum(w * value(t, nodes[t, 0], taken) for t, w in enumerate(weights))

    out, n = {explain.BIAS: game(frozenset())}, len(columns)
    for c in columns:
        rest = [d for d in columns if d != c]
        out[c] = 0.0
        for bits in range(1 << len(rest)):
            taken = frozenset(d for i, d in enumerate(rest) if bits >> i & 1)
            share = factorial(len(taken)) * factorial(n - 1 - len(taken)) / factorial(n)
            out[c] += share * (game(taken | {c}) - game(taken))
    return out


@pytest.mark.parametrize(
    "algorithm, params",
    [
        ("decision_tree", {"maxDepth": 7}),
        ("random_forest", {"numTrees": 3}),
        ("gbt", {"maxIter": 3, "maxDepth": 4}),
    ],
)
@pytest.mark.parametrize("table_columns", [0, 6])
def test_path_contributions_against_all_subsets(orders, monkeypatch, algorithm, params, table_columns):
    monkeypatch.setattr(explain, "TABLE_COLUMNS", table_columns)
    inside, outside = hash_split(orders, ORDER_SPEC.key)
    model = train(inside, ORDER_SPEC, algorithm, params)
    rows = outside.orderBy("o_orderkey").limit(3).collect()
    keys = [r["o_orderkey"] for r in rows]
    got = by_key(
        explain.contributions(model, outside.filter(F.col("o_orderkey").isin(keys)), ORDER_SPEC, method="path")
    )
    for row in rows:
        assert got[row["o_orderkey"]] == pytest.approx(by_cover(model, outside, ORDER_SPEC, row), abs=1e-9)


def test_path_shares_without_cover():
    """A column whose branch no training row took: values by the definition."""
    shares = np.array([0.0, 0.25, 1.0, 0.6])
    patterns = np.array([[i >> d & 1 for d in range(4)] for i in range(16)], bool)
    got = explain.path_shares(patterns, shares)
    for pattern, values in zip(patterns, got):
        def game(taken):
            return np.prod([pattern[d] if d in taken else shares[d] for d in range(4)])

        for d in range(4):
            rest = [e for e in range(4) if e != d]
            want = 0.0
            for bits in range(8):
                taken = {e for i, e in enumerate(rest) if bits >> i & 1}
                want += factorial(len(taken)) * factorial(3 - len(taken)) / 24 * (game(taken | {d}) - game(taken))
            assert values[d] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize(
    "algorithm, params",
    [
        ("random_forest", {"numTrees": 7}),
        ("gbt", {"maxIter": 6, "maxDepth": 9}),
        ("logistic_regression", None),
        ("linear_svm", {"maxIter": 10}),
        ("naive_bayes", None),
    ],
)
def test_path_contributions_add_up_to_the_output(orders, algorithm, params):
    inside, outside = hash_split(widened(orders), WIDE.key)
    model = train(inside, WIDE, algorithm, params)
    odd = outside.withColumns(
        {"weekday": F.when(F.col("o_orderkey") % 5 > 0, F.lit("never")), "n_lines": F.lit(None).cast("int")}
    )
    tree = algorithm in ("random_forest", "gbt")
    output = explain.model_output(model) if tree else explain._margin(model.stages[-1])
    for rows in (outside, odd):
        explained = explain.contributions(model, rows, WIDE, inside, method="path")
        assert exchanges(explained) == exchanges(rows)
        got = by_key(explained)
        outputs = model.transform(rows).select("o_orderkey", output.alias("v")).collect()
        starts = {parts[explain.BIAS] for parts in got.values()}
        assert len(starts) == 1 and len(got) == len(outputs)
        for r in outputs:
            assert len(got[r["o_orderkey"]]) == 9
            assert sum(got[r["o_orderkey"]].values()) == pytest.approx(r["v"], abs=1e-6)
    if tree:
        # A forest's trees see bootstrapped rows, so its start is near the mean output, not equal to it.
        mean = model.transform(inside).agg(F.avg(output)).first()[0]
        assert starts.pop() == pytest.approx(mean, abs=0.05)
    one = explain.explain_row(model, outside, WIDE, (outside.first()["o_orderkey"],), inside, method="path")
    assert [r["feature"] for r in one.collect()][-1] == explain.BIAS
    assert explain.BIAS not in {r["feature"] for r in explain.contribution_summary(explained).collect()}
    with pytest.raises(ValueError):
        explain.contributions(model, outside, WIDE, method="other")


def test_leaves_do_not_grow_with_the_number_of_categories(spark):
    """Splits ask about single values, whatever the number of values a column has."""
    spec = ORDER_SPEC.using(categorical=("c",), numeric=("x",), key=())
    sizes = []
    for n in (30, 3000):
        rows = [(f"v{i % n}", float(i % 11), int(i % n < 3 or i % 11 > 8)) for i in range(2 * n + 600)]
        df = spark.createDataFrame(rows, "c STRING, x DOUBLE, label INT")
        leaves = explain.tree_leaves(train(df, spec, "decision_tree", {"maxDepth": 5}), df, spec)
        assert len(leaves) > 4
        sizes.append(len(pickle.dumps(leaves)) / len(leaves))
    assert sizes[1] < 2 * sizes[0]
