"""Replacement and merging of tables that survive a failed writer."""

import pytest
from pyspark.sql import functions as F

from sensorgraph.sources import tables, versions
from tests.helpers import at, speeds, values

SCHEMA = "sensor_id long, timestamp timestamp_ntz, speed double, event_id long"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def failing(df):
    """Fails in its last task, after others have written their files."""
    return df.withColumn("x", F.when(F.col("k") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("k")).cast("long"))


def test_failed_writer_leaves_the_old_table(spark, path):
    tables.write_gold(spark.range(10).toDF("k"), path)
    with pytest.raises(Exception, match="lost"):
        tables.write_gold(failing(spark.range(0, 100, 1, 20).toDF("k")), path)
    assert tables.read_table(spark, path).columns == ["k"] and tables.read_table(spark, path).count() == 10
    tables.write_gold(spark.range(3).selectExpr("id as other", "'t' as text"), path)
    assert values(tables.read_table(spark, path), by=["other"]) == [(k, "t") for k in range(3)]


def test_table_may_read_what_it_replaces(spark, path):
    tables.write_gold(spark.range(5).toDF("k"), path)
    running = tables.read_table(spark, path)
    tables.write_gold(tables.read_table(spark, path).withColumn("twice", F.col("k") * 2), path)
    assert running.count() == 5  # a reader under way keeps its version until the next write
    assert values(tables.read_table(spark, path), by=["k"]) == [(k, 2 * k) for k in range(5)]
    for k in range(3):
        tables.write_gold(spark.range(k).toDF("k"), path)
    place, files = versions._place(spark, f"{path}/{versions.VERSIONS}")
    assert len(files.listStatus(place)) == 2


def test_plain_table_is_replaced(spark, path):
    spark.range(4).toDF("k").write.parquet(path)
    assert tables.read_table(spark, path).count() == 4
    tables.write_gold(spark.range(2).toDF("k"), path)
    assert tables.read_table(spark, path).count() == 2


def test_second_writer_is_told(spark, path, monkeypatch):
    tables.write_gold(spark.range(4).toDF("k"), path)
    publish = versions._publish

    def late(*args):
        monkeypatch.setattr(versions, "_publish", publish)
        tables.write_gold(spark.range(7).toDF("k"), path)
        publish(*args)

    monkeypatch.setattr(versions, "_publish", late)
    with pytest.raises(versions.Conflict):
        tables.write_gold(spark.range(9).toDF("k"), path)
    assert tables.read_table(spark, path).count() == 7


def test_merge_writes_only_touched_dates(spark, path):
    day = 24 * 60
    first = [(1, at(0), 1.0, 1), (2, at(0), 2.0, 2), (1, at(day), 3.0, 3), (1, at(3 * day), 4.0, 4), (1, at(0), 0.5, 0), (3, None, 9.0, 5)]
    assert len(versions.merge_readings(speeds(spark, first, SCHEMA), path, order="event_id")) == 4
    before = versions.read_manifest(spark, path)["parts"]
    second = [(1, at(day), 30.0, 0), (4, at(day), 40.0, 6), (1, at(5 * day), 50.0, 7), (3, None, 8.0, 1)]
    touched = versions.merge_readings(speeds(spark, second, SCHEMA), path, order="event_id", rows_per_slot=1)
    after = versions.read_manifest(spark, path)["parts"]
    assert {d for d in after if after[d] != before.get(d)} == set(touched) == {"2024-01-07", "2024-01-11", "none"}
    wanted = [(1, at(0), 1.0, 1), (1, at(day), 30.0, 0), (1, at(3 * day), 4.0, 4), (1, at(5 * day), 50.0, 7), (2, at(0), 2.0, 2), (3, None, 8.0, 1), (4, at(day), 40.0, 6)]
    read = lambda: values(tables.read_table(spark, path), "sensor_id", "timestamp", "speed", "event_id", by=["sensor_id", "timestamp"])
    assert read() == wanted
    versions.merge_readings(speeds(spark, second, SCHEMA), path, order="event_id")  # again: nothing changes
    assert read() == wanted
    assert versions.merge_readings(speeds(spark, [], SCHEMA), path) == []
    versions.merge_readings(speeds(spark, second[:1], SCHEMA), path, order="event_id", most_versions=1)
    assert len({f.split("/")[1] for f in versions.read_manifest(spark, path)["parts"].values()}) == 1
    assert read() == wanted


def test_failed_merge_leaves_the_table(spark, path):
    rows = speeds(spark, [(k, at(k), float(k), k) for k in range(20)], SCHEMA)
    versions.merge_readings(rows, path)
    bad = rows.withColumn("speed", F.when(F.col("event_id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.lit(0.0)).cast("double"))
    with pytest.raises(Exception, match="lost"):
        versions.merge_readings(bad, path)
    assert tables.read_table(spark, path).agg(F.sum("speed")).first()[0] == sum(range(20))
    more = rows.where("event_id < 3").withColumn("note", F.lit("new"))
    versions.merge_readings(more, path)  # a column that older rows lack
    assert tables.read_table(spark, path).where("note is null").count() == 17
    versions.replace_table(rows, path + "-whole")
    with pytest.raises(ValueError, match="date"):
        versions.merge_readings(rows, path + "-whole")
