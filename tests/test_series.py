import math

import pytest
from pyspark.sql import functions as F

from sensorgraph.functions.calendar import calendar_columns
from sensorgraph.functions.labels import condition_columns
from sensorgraph.operators import series
from tests.helpers import at, plan, speeds, values


@pytest.fixture(scope="module")
def golden(spark):
    return speeds(spark, [(7, at(0), 60.0), (7, at(5), 0.0), (7, at(10), 30.0), (7, at(15), 45.0)])


def test_calendar_of_a_saturday_morning(golden):
    columns = ("hour", "day_of_week", "week_of_year", "is_weekend", "is_peak_hour", "time_of_day")
    assert set(values(calendar_columns(golden), *columns, by=["timestamp"])) == {
        (8, 7, 1, 1, 1, "Morning")
    }


@pytest.mark.parametrize(
    "hour, part, peak",
    [(4, "Night", 0), (5, "Morning", 0), (6, "Morning", 0), (7, "Morning", 1), (9, "Morning", 1),
     (10, "Morning", 0), (11, "Morning", 0), (12, "Afternoon", 0), (16, "Afternoon", 1),
     (17, "Evening", 1), (18, "Evening", 1), (19, "Evening", 0), (20, "Evening", 0), (21, "Night", 0)],
)
def test_day_parts_and_peaks(spark, hour, part, peak):
    df = calendar_columns(speeds(spark, [(1, at(0).replace(hour=hour), 1.0)]))
    assert values(df, "time_of_day", "is_peak_hour", by=["timestamp"]) == [(part, peak)]


def test_missing_time_is_night(spark):
    assert calendar_columns(speeds(spark, [(1, None, 1.0)])).first()["time_of_day"] == "Night"


def test_lags_labels_and_rolling_golden(golden):
    df = series.rolling_columns(condition_columns(series.lag_columns(golden)))
    columns = (
        "lag_1", "speed_change", "percent_change", "traffic_trend", "congestion_level", "speed_category",
        "rolling_mean_3", "rolling_std_3",
    )
    assert values(df, *columns, by=["timestamp"]) == [
        (None, None, None, "Stable", "Moderate", "Medium", 60.0, None),
        (60.0, -60.0, -100.0, "Decreasing", "Congested", "Low", 30.0, 42.426407),
        (0.0, 30.0, None, "Increasing", "Congested", "Low", 30.0, 30.0),
        (30.0, 15.0, 50.0, "Increasing", "Moderate", "Medium", 25.0, 22.912878),
    ]


def test_target_drops_the_last_row(golden):
    assert values(series.next_target(golden), "target_speed", by=["timestamp"]) == [
        (0.0,), (30.0,), (45.0,)
    ]


def test_target_several_steps_ahead(golden):
    assert values(series.next_target(golden, steps=3), "target_speed", by=["timestamp"]) == [(45.0,)]


def test_labels_of_missing_and_nan_speed(spark):
    df = speeds(spark, [(1, at(0), None), (2, at(0), math.nan)])
    labels = condition_columns(series.lag_columns(df))
    assert values(labels, "congestion_level", "speed_category", by=["sensor_id"]) == [
        ("Congested", "High"),
        ("Free Flow", "High"),
    ]


@pytest.mark.parametrize(
    "speed, congestion, category",
    [(60.01, "Free Flow", "High"), (60.0, "Moderate", "Medium"), (40.0, "Moderate", "Medium"),
     (39.99, "Congested", "Low")],
)
def test_label_borders(spark, speed, congestion, category):
    df = condition_columns(series.lag_columns(speeds(spark, [(1, at(0), speed)])))
    assert values(df, "congestion_level", "speed_category", by=["timestamp"]) == [(congestion, category)]


def test_custom_thresholds(spark):
    df = series.lag_columns(speeds(spark, [(1, at(0), 25.0)]))
    assert condition_columns(df, free_flow=20, moderate=10).first()["congestion_level"] == "Free Flow"


def test_sensor_statistics(golden):
    row = series.sensor_statistics(golden).first().asDict()
    assert {k: round(v, 6) for k, v in row.items()} == {
        "sensor_id": 7, "average_speed": 33.75, "maximum_speed": 60.0, "minimum_speed": 0.0,
        "median_speed": 30.0, "standard_deviation": 25.617377, "variance": 656.25,
    }


def test_lags_ignore_gaps_in_time(spark):
    df = speeds(spark, [(1, at(0), 1.0), (1, at(60 * 24 * 30), 2.0)])
    assert values(series.lag_columns(df), "lag_1", by=["timestamp"]) == [(None,), (1.0,)]


def test_tiebreak_orders_equal_times(spark):
    df = speeds(
        spark, [(1, at(0), 1.0, 2), (1, at(0), 2.0, 1)],
        "sensor_id long, timestamp timestamp_ntz, speed double, event_id long",
    )
    assert values(series.lag_columns(df, tiebreak="event_id"), "lag_1", by=["event_id"]) == [(None,), (2.0,)]


def test_all_window_columns_share_one_shuffle_and_sort(golden):
    text = plan(series.series_columns(golden))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1
    assert text.count("\n+- Window") + text.count("- Window [") >= 1
    assert "Python" not in text


def test_key_column_names_can_be_chosen(spark):
    df = speeds(spark, [(1, at(0), 1.0), (1, at(5), 3.0)]).toDF("road", "at", "flow")
    lags = series.lag_columns(df, lags=(1,), sensor="road", time="at", value="flow")
    assert values(lags, "lag_1", "speed_change", by=["at"]) == [(None, None), (1.0, 2.0)]
    assert lags.select(F.max("lag_1")).first()[0] == 1.0
