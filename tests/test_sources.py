import pytest
from pyspark.sql import functions as F

from sensorgraph.operators import storage
from sensorgraph.sources import inspect, tables
from tests.helpers import at, edges, speeds, values


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_edges_csv_has_fixed_types(spark, tmp_path):
    file = tmp_path / "edges.csv"
    file.write_text("source_sensor,destination_sensor,weight\n773869,767541,0.25\n1,2,\n")
    df = tables.read_edges_csv(spark, str(file))
    assert df.dtypes == [("source_sensor", "bigint"), ("destination_sensor", "bigint"), ("weight", "double")]
    assert values(df, by=["source_sensor"]) == [(1, 2, None), (773869, 767541, 0.25)]


def test_csv_columns_are_picked_by_name(spark, tmp_path):
    file = tmp_path / "edges.csv"
    file.write_text(",weight,destination_sensor,source_sensor\n0,0.5,1,2\n1,x,4,3\n")
    df = tables.read_edges_csv(spark, str(file))
    assert df.columns == ["source_sensor", "destination_sensor", "weight"]
    assert values(df, by=["source_sensor"]) == [(2, 1, 0.5), (3, 4, None)]
    with pytest.raises(Exception, match="(?i)failfast|malformed"):
        tables.read_edges_csv(spark, str(file), mode="FAILFAST").collect()
    given = tables.read_features_csv(spark, str(file), "source_sensor string, weight double")
    assert values(given, by=["source_sensor"]) == [("2", 0.5), ("3", None)]
    (tmp_path / "other.csv").write_text("source_sensor,weight\n1,2\n")
    with pytest.raises(ValueError, match="destination_sensor"):
        tables.read_edges_csv(spark, str(tmp_path / "other.csv"))


def test_csv_export_computes_its_input_once(spark, path, monkeypatch):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "sensor_id long, v array<double>")
    with_widths = f"{path}-given"
    monkeypatch.setattr(tables, "stored", lambda *_: pytest.fail("widths are given"))
    tables.export_csv(df, with_widths, widths={"v": 2})
    assert spark.read.option("header", True).csv(with_widths).columns == ["sensor_id", "v_0", "v_1"]


def test_features_csv_infers_or_takes_a_schema(spark, tmp_path):
    file = tmp_path / "features.csv"
    file.write_text("sensor_id,speed\n1,2.5\n")
    assert tables.read_features_csv(spark, str(file)).dtypes == [("sensor_id", "int"), ("speed", "double")]
    given = tables.read_features_csv(spark, str(file), "sensor_id string, speed float")
    assert given.dtypes == [("sensor_id", "string"), ("speed", "float")]


def test_gold_write_replaces_rows_and_schema(spark, path):
    df = speeds(spark, [(i, at(i), float(i)) for i in range(200)])
    tables.write_gold(df, path, partitions=3)
    tables.write_gold(df.select("sensor_id", F.lit("x").alias("label")), path, partitions=7)
    written = tables.read_table(spark, path)
    assert written.columns == ["sensor_id", "label"]
    assert written.count() == 200
    assert written.select(F.input_file_name()).distinct().count() == 7


def test_gold_write_keeps_partitions_and_splits_files(spark, path):
    df = speeds(spark, [(i, at(i), float(i)) for i in range(200)]).coalesce(1)
    tables.write_gold(df, path, rows_per_file=30)
    written = tables.read_table(spark, path)
    assert written.count() == 200
    assert written.select(F.input_file_name()).distinct().count() == 7


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "lz4", "none"])
def test_codecs(spark, path, tmp_path, codec):
    tables.export_parquet(edges(spark, [(1, 2, 3.0)]), path, codec)
    assert values(tables.read_table(spark, path), by=["weight"]) == [(1, 2, 3.0)]
    names = [f.name for f in (tmp_path / "table").glob("*.parquet")]
    assert names and all((f".{codec}" in n or codec in ("none", "gzip", "lz4")) for n in names)


def test_csv_export_expands_arrays_and_keeps_microseconds(spark, path):
    row = (1, at(0).replace(microsecond=123456), [1.0, 2.0])
    df = spark.createDataFrame([row], "sensor_id long, timestamp timestamp_ntz, v array<double>")
    tables.export_csv(df, path)
    back = tables.read_features_csv(
        spark, path, "sensor_id long, timestamp timestamp_ntz, v_0 double, v_1 double"
    )
    assert tuple(back.first()) == (1, row[1], 1.0, 2.0)


def test_ingest_wide_speeds(spark, path, tmp_path):
    wide = spark.createDataFrame([(at(0), 1.0, None)], "index timestamp_ntz, `101` float, `102` float")
    tables.export_parquet(wide, path)
    silver = str(tmp_path / "silver")
    tables.ingest_speeds(spark, path, silver, "index")
    df = tables.read_table(spark, silver)
    assert set(df.dtypes) == {("timestamp", "timestamp_ntz"), ("sensor_id", "bigint"), ("speed", "double")}
    assert values(df, "sensor_id", "speed", by=["sensor_id"]) == [(101, 1.0), (102, None)]
    with pytest.raises(ValueError, match="clock"):
        tables.ingest_speeds(spark, path, silver, "clock")


def test_ingest_edges(spark, path, tmp_path):
    raw = spark.createDataFrame([("1", "2", "0.5")], "source_sensor string, destination_sensor string, weight string")
    tables.export_parquet(raw, path)
    tables.ingest_edges(spark, path, str(tmp_path / "silver"))
    df = tables.read_table(spark, str(tmp_path / "silver"))
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "double"]
    assert values(df, by=["weight"]) == [(1, 2, 0.5)]


def test_profile_and_sample(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.5)], "rows int, `a.b` double")
    assert values(inspect.profile(df), by=["column"]) == [("a.b", "double", 2, 3), ("rows", "int", 3, 3)]
    assert values(inspect.sample_rows(df, ["rows"], 2), by=["rows"]) == [(1, None), (2, 0.5)]


def test_stored_tables_do_not_collide(spark):
    first = storage.stored(spark.range(3), "same")
    second = storage.stored(spark.range(5), "same")
    assert (first.count(), second.count()) == (3, 5)


def test_shared_folder_is_read_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or storage.shared_folder(spark) == named.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_pushdown_reaches_the_scan(spark, path):
    tables.export_parquet(speeds(spark, [(1, at(0), 1.0)]), path)
    df = tables.read_table(spark, path).where("sensor_id = 1").select("speed")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sensor_id,1)" in text and "ReadSchema: struct<sensor_id:bigint,speed:double>" in text
