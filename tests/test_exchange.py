"""Checked CSV files, mergeable sketches and tensor shards."""

import random

import pytest
from pyspark.sql import functions as F

from sensorgraph.operators import panel, sketches
from sensorgraph.sources import rejects, shards
from tests.helpers import at, speeds, values

SCHEMA = "sensor_id long, timestamp timestamp_ntz, speed double, open boolean, note string"
LINES = """note,speed,sensor_id,timestamp,open,more
a,1.5,1,2024-01-06T08:00:00.250000,true,x
b,n/a,2,2024-01-06 08:05:00,false,x
c,2e1,3.5,yesterday,maybe,x
,,4,,,
d,7,5
e,8,6,06.01.2024 08:10:00,true,x,y
f,NaN,,2024-01-06,true,x
g, 9 , 8 ,2024-02-30,true,x
"""


def test_each_line_is_good_or_rejected(spark, tmp_path):
    (tmp_path / "readings.csv").write_text(LINES)
    good, bad = rejects.read_csv_checked(spark, str(tmp_path), SCHEMA, ["sensor_id"], ["dd.MM.yyyy HH:mm:ss"])
    assert good.dtypes == [("sensor_id", "bigint"), ("timestamp", "timestamp_ntz"), ("speed", "double"), ("open", "boolean"), ("note", "string")]
    found = {r["sensor_id"]: tuple(r) for r in good.collect()}
    assert set(found) == {1, 4} and found[4] == (4, None, None, None, None) and found[1][2:] == (1.5, True, "a")
    told = {r["note"]: [(x["column"], x["reason"]) for x in r["rejects"]] for r in bad.collect()}
    assert told["b"] == [("speed", "not a double")]
    assert told["c"] == [("sensor_id", "not a bigint"), ("timestamp", "not a timestamp_ntz"), ("open", "not a boolean")]
    assert told["d"] == told["e"] == [(None, "wrong number of fields")]
    assert told["f"] == [("sensor_id", "missing")] and told["g"] == [("timestamp", "not a timestamp_ntz")]
    assert good.count() + bad.count() == len(LINES.splitlines()) - 1
    texts = {r["note"]: [x["text"] for x in r["rejects"]] for r in bad.collect()}
    assert texts["c"] == ["3.5", "yesterday", "maybe"] and texts["d"] == ["d,7,5"]
    with pytest.raises(ValueError, match="other"):
        rejects.read_csv_checked(spark, str(tmp_path), "other long")


def test_merged_sketches_are_within_their_error(spark):
    r = random.Random(2)
    rows = [(1 if k % 3 else 2, at(60 * k % 20_000), r.choice([None, float("nan")]) if k % 50 == 0 else r.lognormvariate(3, 1)) for k in range(6000)]
    daily = sketches.reading_sketches(speeds(spark, rows))
    assert daily.groupBy("sensor_id").count().where("count > 10").count() == 2
    for row in sketches.merged_statistics(daily, quantiles=(0.1, 0.5, 0.99)).collect():
        own = sorted(v for s, _, v in rows if s == row["sensor_id"] and v is not None and v == v)
        assert (row["readings"], row["minimum_speed"], row["maximum_speed"]) == (len(own), own[0], own[-1])
        assert row["average_speed"] == pytest.approx(sum(own) / len(own))
        for q in (10, 50, 99):
            rank = sum(v <= row[f"quantile_{q}"] for v in own) / len(own)
            assert abs(rank - q / 100) <= sketches.RANK_ERROR + 1 / len(own)
    links = spark.range(40_000).select((F.col("id") % 2).alias("s"), (F.col("id") % 7).alias("day"), (F.col("id") % 9001).alias("d"))
    for row in sketches.merged_distinct(sketches.distinct_sketches(links, ["s", "day"], "d"), ["s"]).collect():
        assert abs(row["distinct_count"] / 9001 - 1) <= sketches.DISTINCT_ERROR
    assert sketches.merged_statistics(sketches.reading_sketches(speeds(spark, [(1, at(0), None)]))).count() == 0


@pytest.fixture(scope="module")
def dense(spark):
    r = random.Random(4)
    rows = [(s, at(t), r.random(), None if r.random() < 0.2 else float(t * s)) for s in range(5) for t in range(23) if r.random() < 0.8]
    readings = spark.createDataFrame(rows, "sensor_id long, timestamp timestamp_ntz, speed double, target_speed double")
    return panel.dense_panel(readings, ["speed", "target_speed"], mask_missing=True).persist()


@pytest.mark.parametrize("shape", [(4, 2), (30, 8), (1, 1), (23, 5)])
def test_shards_hold_the_panel(spark, dense, tmp_path, shape):
    path = str(tmp_path / "shards")
    shards.write_shards(dense, path, ["speed", "target_speed"], {"speed": (0.5, 0.25)}, *shape)
    by = ["time_index", "node_id"]
    assert values(shards.read_shards(spark, path), by=by) == values(dense, by=by)
    facts = shards.shard_manifest(spark, path)
    assert facts["panel"] == [dense.agg(F.max("time_index")).first()[0] + 1, 5] and facts["shape"] == list(shape)
    stored = shards._table(spark, f"{path}/shards")
    assert {(len(r["speed"]), len(r["target_speed"])) for r in stored.collect()} == {(shape[0] * shape[1],) * 2}
    wanted = panel.sequences(dense, 5, 7, cols=["speed", "target_speed"])
    found = shards.shard_sequences(spark, path, 5, 7, cols=["speed", "target_speed"])
    near = lambda df: {(r["node_id"], r["time_index"]): [None if x is None else round(x, 9) for x in (*r["speed_sequence"], *r["target_speed_sequence"], r["target"])] for r in df.collect()}
    assert near(found) == near(wanted)


def test_shards_refuse_panels_with_holes(spark, dense, tmp_path):
    with pytest.raises(Exception, match="missing or repeated"):
        shards.write_shards(dense.where("not (time_index = 3 and node_id = 2)"), str(tmp_path / "a"), ["speed"], None, 4, 2)
    shards.write_shards(dense.limit(0), str(tmp_path / "b"), ["speed"])
    assert shards.read_shards(spark, str(tmp_path / "b")).count() == 0
    shards.write_shards(dense, str(tmp_path / "b"), ["speed"], None, 4, 2)  # replaces
    assert shards.read_shards(spark, str(tmp_path / "b")).count() == dense.count()
