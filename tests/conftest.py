import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def orders(spark):
    """The prepared order table at the smallest scale, cached."""
    from tallygrove.operators.prepare import prepare
    from tallygrove.plans.fixtures import ORDER_SPEC, order_profile

    table = prepare(order_profile(spark, SMALL), ORDER_SPEC).persist()
    yield table
    table.unpersist()


@pytest.fixture(scope="session")
def scored(orders):
    """Naive Bayes trained on the first part of the split and applied to the second."""
    from tallygrove.operators.classifiers import train
    from tallygrove.operators.splits import hash_split
    from tallygrove.plans.fixtures import ORDER_SPEC

    inside, outside = hash_split(orders, ORDER_SPEC.key)
    model = train(inside, ORDER_SPEC, "naive_bayes")
    return model, inside, outside, model.transform(outside)
