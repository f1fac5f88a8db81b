"""Windows continued from a carry, and fitted state that is merged and applied again."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from sensorgraph.config import SeriesConfig
from sensorgraph.operators import encode, fitted
from sensorgraph.operators.carry import SETTLED, continue_series
from sensorgraph.operators.series import series_columns
from tests.helpers import at, speeds, values

SCHEMA = "sensor_id long, timestamp timestamp_ntz, speed double, event_id long"
CFG = SeriesConfig(tiebreak="event_id", lags=(1, 3), frames=(3, 4))
R = random.Random(8)
ROWS = [(R.choice([0, 0, 0, 1, 2, None]), at(k // 2), None if R.random() < 0.1 else float(R.randrange(90)), k) for k in range(160)]


@pytest.mark.parametrize("cuts,rows_per_task", [((80,), None), ((1, 2, 3, 120, 120), None), ((60, 61), 10)])
def test_deliveries_equal_the_whole(spark, cuts, rows_per_task):
    cfg = SeriesConfig(tiebreak="event_id", lags=(1, 3), frames=(3, 4), rows_per_task=rows_per_task)
    whole = series_columns(speeds(spark, ROWS, SCHEMA), CFG).withColumn("has_next", F.lead("event_id").over(_by_time()).isNotNull())
    wanted = values(whole.where("has_next").drop("has_next"), by=["event_id"])
    state, found = None, []
    for start, end in zip((0, *cuts), (*cuts, len(ROWS))):
        rows, state = continue_series(speeds(spark, ROWS[start:end], SCHEMA), state, cfg)
        found += values(rows.select(*whole.columns[:-1]), by=["event_id"])
    assert sorted(found, key=lambda row: row[3]) == wanted
    kept = state.groupBy("sensor_id").agg(F.count("*").alias("n"), F.count_if(~F.col(SETTLED)).alias("open")).collect()
    assert all(row["n"] <= 4 and row["open"] == 1 for row in kept)


def _by_time():
    from pyspark.sql import Window

    return Window.partitionBy("sensor_id").orderBy("timestamp", "event_id")


def test_earlier_readings_are_refused(spark):
    _, state = continue_series(speeds(spark, ROWS[:40], SCHEMA), None, CFG)
    with pytest.raises(ValueError, match="later"):
        continue_series(speeds(spark, ROWS[38:50], SCHEMA), state, CFG)
    rows, state = continue_series(speeds(spark, [], SCHEMA), state, CFG)
    assert rows.count() == 0 and state.where(f"not {SETTLED}").count() == len({r[0] for r in ROWS[:40]})


def test_merged_state_is_the_state_of_all(spark):
    data = [(1e9 + R.random(), R.randrange(5), R.choice("ab") if k % 7 else None, None) for k in range(90)]
    frame = spark.createDataFrame(data, "x double, n int, kind string, none double")
    cols = ["x", "n", "none"]
    pieces = [frame.where(f"n = {k}") for k in range(6)]  # the last one is empty
    merged = fitted.merge_states(*[fitted.fit_state(p, cols, ["kind"]) for p in pieces]).collect()
    by = {(r["column"], r["label"]): r for r in merged}
    xs = [row[0] for row in data]
    assert by["x", None]["count"] == 90 and by["x", None]["mean"] == pytest.approx(statistics.fmean(xs), abs=1e-6)
    assert (by["x", None]["deviations"] / 90) ** 0.5 == pytest.approx(statistics.pstdev(xs), rel=1e-5)
    assert (by["n", None]["low"], by["n", None]["high"]) == (0.0, 4.0)
    assert by["none", None]["count"] == 0 and by["none", None]["mean"] is None
    assert {k[1]: r["count"] for k, r in by.items() if k[0] == "kind"} == {c: sum(row[2] == c for row in data) for c in "ab"}


def test_transforms_read_the_state_only(spark):
    frame = spark.createDataFrame([(1.0, 5, "a"), (2.0, 5, "b"), (6.0, 5, "b")], "x double, n int, kind string")
    state = fitted.fit_state(frame, ["x", "n"], ["kind"])
    other = spark.createDataFrame([(3.0, 7, "a"), (None, 5, "c")], "x double, n int, kind string")
    scaled = fitted.standard_scale_by(other, state, ["x", "n"])
    assert {(r["x"], r["n"]) for r in scaled.collect()} == {(0.0, 0.0), (None, 0.0)}
    ranged = fitted.minmax_scale_by(other, state, ["x", "n"]).collect()
    assert {(r["x"], r["n"]) for r in ranged} == {(0.4, 0.5), (None, 0.5)}
    assert {(r["kind"], r["kind_index"]) for r in fitted.index_labels_by(other, state, ["kind"]).collect()} == {("a", 1.0), ("c", 2.0)}
    with pytest.raises(ValueError, match="y"):
        fitted.standard_scale_by(other, state, ["y"])
    same = encode.standard_scale(frame, ["x"]).select("x").collect()
    assert [r["x"] for r in fitted.standard_scale_by(frame, state, ["x"]).collect()] == pytest.approx([r["x"] for r in same])
