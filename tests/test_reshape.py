import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sensorgraph.functions.parsing import to_number, to_ts
from sensorgraph.operators import encode, reshape
from sensorgraph.operators.graph import restrict_to_graph
from tests.helpers import at, edges, speeds, values


def test_wide_to_long_keeps_empty_cells(spark):
    wide = spark.createDataFrame(
        [(at(0), 1, 2.5), (at(5), None, 4.0)], "timestamp timestamp_ntz, `77` int, `a.b` double"
    )
    long = reshape.wide_to_long(wide)
    assert long.dtypes[1:] == [("sensor_id", "string"), ("speed", "double")]
    assert values(long, "sensor_id", "speed", by=["timestamp", "sensor_id"]) == [
        ("77", 1.0), ("a.b", 2.5), ("77", None), ("a.b", 4.0)
    ]


def test_long_input_passes_through(spark):
    df = speeds(spark, [(1, at(0), 1.0)])
    assert reshape.wide_to_long(df) is df


def test_matrix_to_edges(spark):
    matrix = spark.createDataFrame([(1, 0.0, 2.0), (2, 3.0, None)], "source_sensor long, `1` double, `2` double")
    assert values(reshape.matrix_to_edges(matrix), by=["source_sensor"]) == [(1, 2, 2.0), (2, 1, 3.0)]
    kept = reshape.matrix_to_edges(matrix, keep_zero=True)
    assert values(kept, by=["source_sensor", "destination_sensor"]) == [(1, 1, 0.0), (1, 2, 2.0), (2, 1, 3.0)]
    assert dict(kept.dtypes)["destination_sensor"] == "bigint"


def test_required_columns(spark):
    df = speeds(spark, [])
    reshape.require_columns(df, reshape.SERIES_COLUMNS)
    with pytest.raises(ValueError, match="weight"):
        reshape.require_columns(df, ["speed", "weight"])


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0, True, at(0))], "i int, s string, d double, b boolean, t timestamp")
    assert reshape.numeric_columns(df) == ["i", "d"]
    assert reshape.numeric_columns(df, ["d"]) == ["i"]


def test_vectors_to_arrays_and_flat_columns(spark):
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 2.0])), (2, Vectors.sparse(2, {}))], ["k", "v"])
    arrays = reshape.vectors_to_arrays(df)
    assert dict(arrays.dtypes)["v"] == "array<double>"
    flat = reshape.flatten_arrays(arrays)
    assert flat.columns == ["k", "v_0", "v_1"]
    assert values(flat, by=["k"]) == [(1, 1.0, 2.0), (2, 0.0, 0.0)]


def test_fills_and_drops_treat_nan_as_missing(spark):
    df = speeds(spark, [(1, at(0), math.nan), (2, at(0), None), (3, at(0), 5.0)])
    assert values(reshape.drop_missing(df, ["speed"]), "sensor_id", by=["sensor_id"]) == [(3,)]
    assert values(reshape.fill_zero(df, ["speed"]), "speed", by=["sensor_id"]) == [(0.0,), (0.0,), (5.0,)]
    filled = reshape.fill_defaults(df, {"speed": 7.0, "absent": 1})
    assert values(filled, "speed", by=["sensor_id"]) == [(7.0,), (7.0,), (5.0,)]


def test_drop_if_present(spark):
    assert reshape.drop_if_present(speeds(spark, []), ["speed", "features"]).columns == ["sensor_id", "timestamp"]


def test_restrict_to_graph(spark):
    df = speeds(spark, [(1, at(0), 1.0), (2, at(0), 1.0), (3, at(0), 1.0)])
    kept = restrict_to_graph(df, edges(spark, [(1, 3, 1.0), (3, 3, 1.0)]))
    assert values(kept, "sensor_id", by=["sensor_id"]) == [(1,), (3,)]


@pytest.mark.parametrize(
    "text, number",
    [("1.5", 1.5), (" -2 ", -2.0), ("+.5", 0.5), ("3.", 3.0), ("1e3", 1000.0), ("1E-1", 0.1), ("inf", math.inf),
     ("-Infinity", -math.inf), ("1d", None), ("2f", None), ("n/a", None), ("", None), ("1 2", None), (None, None)],
)
def test_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string").select(to_number("t").alias("n"))
    assert df.first()["n"] == number


def test_to_timestamp(spark):
    df = spark.createDataFrame([("2024-01-06 08:00:00",), ("2024-01-06",), ("soon",)], "t string")
    found = df.select(to_ts("t").alias("at"))
    assert found.dtypes == [("at", "timestamp_ntz")]
    assert [r["at"] for r in found.collect()] == [at(0), at(0).replace(hour=0), None]


def labels(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", "b", "c", None])], "k int, kind string")


def test_label_index_and_one_hot_golden(spark):
    df = encode.one_hot(encode.label_index(labels(spark), ["kind"]), ["kind"])
    flat = reshape.flatten_arrays(reshape.vectors_to_arrays(df.select("k", "kind_index", "kind_vector")))
    assert values(flat, by=["k"]) == [
        (0, 0.0, 1.0, 0.0, 0.0), (1, 1.0, 0.0, 1.0, 0.0), (2, 0.0, 1.0, 0.0, 0.0),
        (3, 2.0, 0.0, 0.0, 1.0), (4, 3.0, 0.0, 0.0, 0.0),
    ]


def test_label_index_of_unseen_labels(spark):
    df = labels(spark)
    indexed = encode.label_index(df, ["kind"], fit_df=df.where("kind = 'a'"))
    assert [v for (v,) in values(indexed, "kind_index", by=["k"])] == [1.0, 0.0, 1.0, 1.0, 1.0]


def test_minmax_golden(spark):
    df = spark.createDataFrame([(float(x), 7.0, None) for x in (1, 2, 3, 4, 9)], "x double, c double, n double")
    assert values(encode.minmax_scale(df, ["x", "c", "n"]), by=["x"]) == [
        (0.0, 0.5, None), (0.125, 0.5, None), (0.25, 0.5, None), (0.375, 0.5, None), (1.0, 0.5, None)
    ]


def test_scaling_can_be_fitted_elsewhere(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    fit = spark.createDataFrame([(0.0,), (5.0,)], "x double")
    assert values(encode.minmax_scale(df, ["x"], fit), by=["x"]) == [(0.0,), (2.0,)]
    assert values(encode.standard_scale(df, ["x"], fit), by=["x"]) == [(-1.0,), (3.0,)]


def test_standard_scale_uses_the_population(spark):
    df = spark.createDataFrame([(1.0, 0.1), (3.0, 0.1), (5.0, 0.1)], "x double, c double")
    scaled = encode.standard_scale(df, ["x", "c"])
    std = math.sqrt(8 / 3)
    assert values(scaled, by=["x"]) == [(round(-2 / std, 6), 0.0), (0.0, 0.0), (round(2 / std, 6), 0.0)]


def test_assemble_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "k int, a double, b double")
    assert encode.assemble(df, ["a", "b"], "v").first()["v"].toArray().tolist() == [0.0, 2.0]


def test_label_frequency(spark):
    found = encode.label_frequency(labels(spark), ["kind"])
    assert values(found, by=["label"]) == [("kind", "a", 1), ("kind", "b", 2), ("kind", "c", 1)]


def test_moments_and_ranges(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert tuple(encode.column_moments(df, ["x"]).first()) == (2.0, 1.0)
    assert tuple(encode.column_ranges(df, ["x"]).first()) == (1.0, 3.0)
    assert df.select(F.col("x")).count() == 2
