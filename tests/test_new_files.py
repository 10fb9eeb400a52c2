"""Scoring what came since the last run."""

from pyspark.sql import functions as F

from tallygrove.operators.classifiers import train
from tallygrove.plans import jobs
from tallygrove.plans.fixtures import ORDER_SPEC
from tallygrove.plans.spec import JobSpec
from tallygrove.sources.models import save_model


def test_each_file_once(spark, orders, tmp_path):
    spec = JobSpec(ORDER_SPEC.using(sentinel_columns=(), label_source=None), "naive_bayes")
    model_path, drops, out, progress = (str(tmp_path / n) for n in ("model", "drops", "out", "progress"))
    save_model(train(orders, ORDER_SPEC, "naive_bayes"), model_path)
    rows = orders.drop("label")
    thirds = [rows.filter(F.col("o_orderkey") % 3 == i) for i in range(3)]
    sizes = [t.count() for t in thirds]

    def run(**more):
        return jobs.score_new_files(spark, spec, drops, model_path, out, progress, **more)

    thirds[0].write.parquet(drops)
    assert run() == sizes[0]
    assert run() == 0
    thirds[1].repartition(3).write.mode("append").parquet(drops)
    thirds[2].repartition(2).write.mode("append").parquet(drops)
    assert run(files_per_batch=1) == sizes[1] + sizes[2]
    assert run() == 0
    found = spark.read.parquet(out)
    want = jobs.predict_job(spark, spec, drops, model_path, str(tmp_path / "once"))
    shown = ["o_orderkey", "prob", "prediction"]
    assert found.count() == rows.count()
    assert found.select(shown).exceptAll(want.select(shown)).count() == 0
    # A lost output is written again from the progress that is kept: a new progress scores all anew.
    again = str(tmp_path / "again")
    assert jobs.score_new_files(spark, spec, drops, model_path, again, str(tmp_path / "p2"), form="classes") == rows.count()
    assert spark.read.parquet(again).columns[:3] == ["predict", "p0", "p1"]


def test_delimited_text(spark, tmp_path):
    table = ORDER_SPEC.using(
        schema="o_orderkey LONG, o_orderstatus STRING, o_orderpriority STRING, c_mktsegment STRING, n_lines INT, sum_qty DOUBLE",
        label_source=None, sentinel_columns=(), dropped=(),
    )
    rows = [(i, "O", f"{i % 3}", "X", i % 5 + 1, float(i), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, table.schema + ", label INT")
    save_model(train(df, table, "naive_bayes"), str(tmp_path / "model"))
    df.drop("label").write.csv(str(tmp_path / "drops"))
    spec = JobSpec(table, "naive_bayes")
    n = jobs.score_new_files(
        spark, spec, str(tmp_path / "drops"), str(tmp_path / "model"), str(tmp_path / "out"), str(tmp_path / "progress")
    )
    assert n == 40 == spark.read.parquet(str(tmp_path / "out")).count()
