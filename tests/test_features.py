import pytest

from tallygrove.operators import features
from tallygrove.plans.spec import TableSpec

SPEC = TableSpec(categorical=("c",), numeric=("x",))


def test_integer_mean_is_cut_and_nan_counts_as_missing(spark):
    ints = spark.createDataFrame([(2,), (3,), (None,)], "x INT")
    assert [r["x_IMPUTED"] for r in features.impute_mean(ints, ["x"]).collect()] == [2, 3, 2]
    doubles = spark.createDataFrame([(2.0,), (3.0,), (None,), (float("nan"),)], "x DOUBLE")
    filled = [r["x_IMPUTED"] for r in features.impute_mean(doubles, ["x"]).collect()]
    assert filled == [2.0, 3.0, 2.5, 2.5]


def test_index_by_frequency_then_value(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None]], "c STRING")
    got = {r["c"]: r["c_idx"] for r in features.index_categories(df, ["c"]).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}


def test_unseen_and_null_give_zero_vectors(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c STRING, x DOUBLE")
    fitted = features.feature_pipeline(SPEC).fit(train)
    other = spark.createDataFrame([("z", 1.0), (None, None), ("b", 0.0)], "c STRING, x DOUBLE")
    vectors = [r["features"].toArray().tolist() for r in fitted.transform(other).collect()]
    assert vectors == [[0.0, 0.0, 1.0], [0.0, 0.0, 2.0], [0.0, 1.0, 0.0]]


def test_names_cover_every_slot(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c STRING, x DOUBLE")
    frame = features.feature_frame(df, SPEC)
    assert features.feature_slots(frame) == [(0, "c_vec_a"), (1, "c_vec_b"), (2, "x_IMPUTED")]
    assert features.slot_sources(frame, SPEC) == [(0, "c"), (1, "c"), (2, "x")]


@pytest.mark.parametrize(
    "spec, names",
    [
        (SPEC.using(numeric=()), ["c_vec_a", "c_vec_b"]),
        (SPEC.using(categorical=()), ["x_IMPUTED"]),
    ],
)
def test_names_with_one_kind_of_column(spark, spec, names):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c STRING, x DOUBLE")
    assert [n for _, n in features.feature_slots(features.feature_frame(df, spec))] == names


def test_sources_of_columns_that_share_a_prefix(spark):
    spec = TableSpec(categorical=("a", "a_vec"), numeric=())
    df = spark.createDataFrame([("1", "2"), ("3", "4")], "a STRING, a_vec STRING")
    frame = features.feature_pipeline(spec.using(categorical=("a",))).fit(df.select("a"))
    assert frame.transform(df.select("a")).columns == ["a", "a_idx", "a_vec", "features"]


def test_too_many_categories_are_refused(spark):
    df = spark.createDataFrame([(str(i), 1.0) for i in range(200)], "c STRING, x DOUBLE")
    with pytest.raises(ValueError, match="max_categories"):
        features.check_inputs(df, SPEC.using(max_categories=50))


def test_negative_numbers_are_refused_for_naive_bayes(spark):
    df = spark.createDataFrame([("a", -1.0)], "c STRING, x DOUBLE")
    features.check_inputs(df, SPEC)
    with pytest.raises(ValueError, match="non-negative"):
        features.check_inputs(df, SPEC, non_negative=True)
