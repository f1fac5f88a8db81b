"""The cut windows must equal the plain ones, whatever the share of one series."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sensorgraph.operators.ordered import over_ordered
from sensorgraph.operators.series import series_columns
from sensorgraph.config import SeriesConfig
from tests.helpers import at, speeds, values

SCHEMA = "sensor_id long, timestamp timestamp_ntz, speed double, event_id long"


def skewed_rows(seed=1, n=900):
    """A third of all rows from one sensor, in bursts, with gaps, ties and missing values."""
    draw = random.Random(seed)
    rows, minute = [], 0
    for i in range(n):
        minute += draw.choice([0, 0, 1, 1, 2, 500])
        sensor = 0 if draw.random() < 0.34 else draw.randrange(1, 12)
        speed = None if draw.random() < 0.05 else float(draw.randrange(0, 90))
        rows.append((sensor, at(minute), speed, i))
    return rows


def expected(rows, before, after):
    """Brute force: neighbours by position in each sensor's ordered list."""
    found = {}
    by_sensor = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1], r[3])):
        by_sensor.setdefault(row[0], []).append(row)
    for series in by_sensor.values():
        for i, row in enumerate(series):
            lag = series[i - before][2] if i >= before else None
            lead = series[i + after][2] if i + after < len(series) else None
            frame = tuple(r[3] for r in series[max(0, i - before) : i + 1])
            found[row[3]] = (lag, lead, frame)
    return found


def run(df, before, after, rows_per_task, order=("timestamp", "event_id"), keys=("sensor_id",)):
    result = over_ordered(
        df, list(keys), list(order),
        lambda w: {
            "back": F.lag("speed", before).over(w),
            "ahead": F.lead("speed", after).over(w),
            "frame": F.collect_list("event_id").over(w.rowsBetween(-before, 0)),
        },
        before=before, after=after, rows_per_task=rows_per_task,
    )
    rows = result.collect()
    assert result.columns == [*df.columns, "back", "ahead", "frame"]
    assert len(rows) == df.count()
    return {r["event_id"]: (r["back"], r["ahead"], tuple(r["frame"])) for r in rows}


@pytest.mark.parametrize(
    "rows_per_task, before, after",
    [(1, 12, 1), (7, 5, 12), (40, 12, 1), (40, 1, 3), (150, 12, 1), (10_000, 5, 12), (None, 12, 1)],
)
def test_cut_windows_equal_brute_force(spark, rows_per_task, before, after):
    rows = skewed_rows()
    df = speeds(spark, rows, SCHEMA)
    assert run(df, before, after, rows_per_task) == expected(rows, before, after)


@pytest.mark.parametrize("seed", range(2))
def test_random_data(spark, seed):
    rows = skewed_rows(seed + 10, 400)
    assert run(speeds(spark, rows, SCHEMA), 3, 2, 25) == expected(rows, 3, 2)


def test_missing_keys_and_times_are_kept(spark):
    rows = skewed_rows(5, 300)
    rows = [(None if r[0] == 0 else r[0], None if r[3] % 50 == 0 else r[1], r[2], r[3]) for r in rows]
    expected_rows = expected([(r[0], r[1] or dt.datetime(1, 1, 1), r[2], r[3]) for r in rows], 4, 1)
    assert run(speeds(spark, rows, SCHEMA), 4, 1, 20) == expected_rows


def test_one_instant_stays_together(spark):
    rows = [(1, at(0), float(i), i) for i in range(50)]
    assert run(speeds(spark, rows, SCHEMA), 3, 2, 10) == expected(rows, 3, 2)


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp"])
def test_other_order_types(spark, kind):
    rows = skewed_rows(3, 300)
    df = speeds(spark, rows, SCHEMA)
    day = F.date_diff(F.to_date("timestamp"), F.lit("2024-01-01").cast("date"))
    order = {
        "long": day.cast("long"), "double": day.cast("double"), "date": F.to_date("timestamp"),
        "timestamp": F.col("timestamp").cast("timestamp"),
    }[kind]
    df = df.withColumn("timestamp", order)
    cut = run(df, 6, 2, 30)
    assert cut == run(df, 6, 2, None)


def test_several_keys(spark):
    rows = skewed_rows(8, 400)
    df = speeds(spark, rows, SCHEMA).withColumn("kind", F.col("event_id") % 2)
    assert run(df, 4, 2, 15, keys=("sensor_id", "kind")) == run(df, 4, 2, None, keys=("sensor_id", "kind"))


def test_all_series_columns_with_a_hot_sensor(spark):
    df = speeds(spark, skewed_rows(4, 600), SCHEMA)
    whole = series_columns(df, SeriesConfig(tiebreak="event_id"))
    cut = series_columns(df, SeriesConfig(tiebreak="event_id", rows_per_task=20))
    assert whole.columns == cut.columns
    assert values(whole, by=["event_id"]) == values(cut, by=["event_id"])


def far(year):
    return dt.datetime(year, 1, 1)


def burst():
    """Nine tenths of a series within one hour of ten years."""
    return [(0, at(1440 * i), 1.0, i) for i in range(300)] + [
        (0, at(200_000) + dt.timedelta(seconds=i), 1.0, 1000 + i) for i in range(2700)
    ]


EVEN = [(0, at(i), float(i), i) for i in range(2000)] + [(1, at(i), 1.0, 2000 + i) for i in range(50)]
SHAPES = {
    "even": EVEN,
    "outliers in the series": [*EVEN, (0, far(1970), 1.0, 9000), (0, far(2200), 1.0, 9001)],
    "outliers elsewhere": [*EVEN, (2, far(1970), 1.0, 9000), (1, far(2200), 1.0, 9001)],
    "burst": burst(),
    "within a second": [(0, at(0) + dt.timedelta(microseconds=37 * i), 1.0, i) for i in range(2000)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_pieces_are_bounded(spark, shape):
    """No (sensor, piece) group may come near the size of the hot sensor, whatever its times."""
    from sensorgraph.operators import ordered

    rows = SHAPES[shape]
    df = speeds(spark, rows, SCHEMA)
    axis = ordered._axis(df, "timestamp")
    series = df.groupBy("sensor_id").agg(F.count("*").alias("rows"), F.min(axis).alias("low"), F.max(axis).alias("high"))
    pieces = ordered._cut(df, ["sensor_id"], "timestamp", 12, 1, 200, series)
    sizes = [r["count"] for r in pieces.groupBy("sensor_id", ordered._PIECE).count().collect()]
    assert max(sizes) < 2 * 200
    assert pieces.where(ordered._OWN).count() == len(rows)
    assert run(df, 12, 1, 200) == expected(rows, 12, 1)


@pytest.mark.parametrize("rows_per_task", [30])
def test_many_rows_get_more_partitions_in_the_same_shuffle(spark, monkeypatch, rows_per_task):
    from sensorgraph.operators import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 40)
    rows = skewed_rows(9, 400)
    df = over_ordered(
        speeds(spark, rows, SCHEMA), ["sensor_id"], ["timestamp", "event_id"],
        lambda w: {"back": F.lag("speed", 2).over(w)}, before=2, rows_per_task=rows_per_task,
    )
    text = df._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "Exchange hashpartitioning(sensor_id" in line]
    assert len(windows) == 1 and ", 10), REPARTITION_BY_NUM" in windows[0]
    found = {r["event_id"]: r["back"] for r in df.collect()}
    assert found == {k: v[0] for k, v in expected(rows, 2, 1).items()}


@pytest.mark.parametrize("odd", [(float("inf"),), (float("-inf"), float("nan"), None), (1e308, -1e308, float("inf")), (5e-324, 0.0)])
def test_axis_values_without_a_range(spark, odd):
    """Infinite, undefined, missing, huge and tiny axis values end the division and keep the order."""
    rows = [(1, float(k % 150), k) for k in range(200)] + [(1, x, 1000 + 3 * j + i) for j, x in enumerate(odd) for i in range(3)]
    df = spark.createDataFrame(rows, "s int, x double, k long").repartition(3)
    columns = lambda w: {"before": F.lag("k", 2).over(w), "after": F.lead("k").over(w)}
    cut = over_ordered(df, ["s"], ["x", "k"], columns, before=2, after=1, rows_per_task=20)
    whole = over_ordered(df, ["s"], ["x", "k"], columns, rows_per_task=None)
    assert sorted(map(tuple, cut.drop("x").collect())) == sorted(map(tuple, whole.drop("x").collect()), key=lambda t: t)
