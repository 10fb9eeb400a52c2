"""Scores are replaced without a gap."""

import pytest
from pyspark.sql import functions as F

from tallygrove.sources import tables
from tallygrove.sources.tables import drop_old_scores, read_scores, write_scores


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_the_last_publication_is_read(spark, tmp_path):
    path = str(tmp_path / "scores") + "/"
    for n in (3, 5, 0, 2):
        write_scores(spark.range(n).withColumn("label", F.lit(n)), path)
        assert ids(read_scores(spark, path)) == list(range(n))
    # A table may be replaced by what is read from it.
    write_scores(read_scores(spark, path).filter("id > 0"), path)
    assert ids(read_scores(spark, path)) == [1]


def test_a_job_that_dies_leaves_the_old_scores(spark, tmp_path):
    path = str(tmp_path / "scores")
    write_scores(spark.range(4), path)
    before = read_scores(spark, path)
    dying = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("dead"))).alias("id"))
    with pytest.raises(Exception, match="dead"):
        write_scores(dying, path)
    assert ids(before) == ids(read_scores(spark, path)) == [0, 1, 2, 3]


def test_a_job_that_dies_before_the_pointer_leaves_the_old_scores(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "scores")
    write_scores(spark.range(4), path)

    def dead(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_versions", dead)
        with pytest.raises(KeyboardInterrupt):
            write_scores(spark.range(9), path)
    assert ids(read_scores(spark, path)) == [0, 1, 2, 3]
    write_scores(spark.range(2), path)
    assert ids(read_scores(spark, path)) == [0, 1]


def test_readers_keep_what_they_began_with(spark, tmp_path):
    path = str(tmp_path / "scores")
    write_scores(spark.range(3), path)
    begun = read_scores(spark, path)
    write_scores(spark.range(6), path)
    assert drop_old_scores(spark, path) == 0
    assert ids(begun) == [0, 1, 2]
    write_scores(spark.range(7), path)
    assert drop_old_scores(spark, path) == 1
    assert drop_old_scores(spark, path, keep=1) == 1
    assert ids(read_scores(spark, path)) == list(range(7))
    assert len(list((tmp_path / "scores").glob("scores-*"))) == 1
    with pytest.raises(ValueError):
        drop_old_scores(spark, path, keep=0)


def test_plain_tables_are_read_as_before(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(3).write.parquet(path)
    assert ids(read_scores(spark, path)) == [0, 1, 2]
    write_scores(spark.range(5), path)
    assert ids(read_scores(spark, path)) == [0, 1, 2, 3, 4]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_scores(spark, str(tmp_path / "nothing"))
