"""The feature stages of a search are worked out from counted rows, once for all folds."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tallygrove.operators import features, selection
from tallygrove.operators.classifiers import ROWS, counted_rows
from tallygrove.operators.features import FEATURES, feature_pipeline, fit_without_parts
from tallygrove.plans.spec import TableSpec
from tallygrove.sources.models import load_model, save_model
from tallygrove.sources.scratch import scratch_path

SPEC = TableSpec(categorical=("kind", "size"), numeric=("x", "n"), key=("id",))


@pytest.fixture(scope="module")
def rows(spark):
    """Categories as frequent as others, some in one fold alone; nulls and NaN; a key that comes twice; no fold."""
    made = spark.range(1200).select(
        "id",
        (F.when(F.col("id") % 50 > 0, F.col("id") % 3)).cast("int").alias("fold"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 4)).alias("kind"),
        F.when(F.col("id") % 3 == 1, F.lit(9)).otherwise(F.col("id") % 2).alias("size"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).when(F.col("id") % 13 > 0, (F.col("id") % 17) / 2).alias("x"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 9).cast("int").alias("n"),
        (F.col("id") % 17 > 8).cast("int").alias("label"),
    )
    table = made.unionAll(made.filter("id % 10 = 0")).persist()
    yield table
    table.unpersist()


def test_stages_are_those_of_single_rows(spark, rows):
    with counted_rows(rows, SPEC, "fold") as (counted, exact):
        assert exact
        got = fit_without_parts(counted, SPEC, ROWS, "fold", 3)
    plain = [feature_pipeline(SPEC).fit(t) for t in (*(rows.filter(F.col("fold") != k) for k in range(3)), rows)]
    assert len(got) == 4
    for one, other in zip(got, plain):
        assert one.stages[1].labelsArray == other.stages[1].labelsArray
        assert one.stages[0].surrogateDF.first().asDict() == pytest.approx(other.stages[0].surrogateDF.first().asDict())
        assert one.stages[0].surrogateDF.schema.names == other.stages[0].surrogateDF.schema.names
        tables = [m.transform(rows).select("id", "fold", FEATURES) for m in (one, other)]
        assert tables[0].schema == tables[1].schema
        assert tables[0].exceptAll(tables[1]).isEmpty() and tables[1].exceptAll(tables[0]).isEmpty()
    path = scratch_path(spark, "stages")
    save_model(got[0], path)
    again = load_model(path).transform(rows).select("id", FEATURES)
    assert again.exceptAll(plain[0].transform(rows).select("id", FEATURES)).isEmpty()


def test_a_column_without_numbers_or_many_categories_are_left_to_the_stages(rows, monkeypatch):
    with counted_rows(rows.withColumn("x", F.lit(None).cast("double")), SPEC, "fold") as (counted, _):
        assert fit_without_parts(counted, SPEC, ROWS, "fold", 3) is None
    monkeypatch.setattr(features, "MOST_LABELS", 6)
    with counted_rows(rows, SPEC, "fold") as (counted, _):
        assert fit_without_parts(counted, SPEC, ROWS, "fold", 3) is None


def test_a_search_fits_its_stages_without_passes_over_the_rows(rows, monkeypatch):
    seen, fit = [], Pipeline._fit
    monkeypatch.setattr(Pipeline, "_fit", lambda self, df: seen.append(df.columns) or fit(self, df))
    selection.search(rows.drop("fold"), SPEC, [selection.Candidate("decision_tree", {"maxDepth": 2})], folds=2)
    assert len(seen) == 3 and all(ROWS in columns for columns in seen)
