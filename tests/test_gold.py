import random

import pytest
from pyspark.sql import functions as F

from sensorgraph.config import GoldConfig, SeriesConfig
from sensorgraph.plans.features import (
    build_series_features,
    gold_features,
    scaled_inputs,
    series_frame,
)
from tests.helpers import at, edges, plan, speeds, values

COLUMNS = """sensor_id timestamp speed
date hour minute day_of_week day_of_month week_of_year month is_weekend is_peak_hour time_of_day
lag_1 lag_2 lag_3 lag_6 lag_12 speed_change
rolling_mean_3 rolling_std_3 rolling_max_3 rolling_min_3
rolling_mean_6 rolling_std_6 rolling_max_6 rolling_min_6
rolling_mean_12 rolling_std_12 rolling_max_12 rolling_min_12
congestion_level speed_category traffic_trend percent_change
hour_sin hour_cos day_sin day_cos month_sin month_cos target_speed
time_of_day_index congestion_level_index speed_category_index traffic_trend_index
time_of_day_vector congestion_level_vector speed_category_vector traffic_trend_vector
out_degree in_degree degree out_weight_degree in_weight_degree weighted_degree
neighbor_count avg_neighbor_weight pagerank""".split()


def readings(spark, sensors=(1, 2, 3, 4, 5), steps=30):
    draw = random.Random(3)
    return speeds(
        spark, [(s, at(37 * i), float(draw.randrange(90))) for s in sensors for i in range(steps)]
    )


NETWORK = [(1, 2, 2.0), (1, 3, 1.0), (2, 3, 3.0), (4, 4, 5.0)]


def test_gold_columns_and_rows(spark):
    df = readings(spark)
    gold = gold_features(df, edges(spark, NETWORK))
    assert gold.columns == COLUMNS and len(COLUMNS) == 59
    assert gold.count() == df.count() - 5  # the last row of each sensor has no target
    types = dict(gold.dtypes)
    assert types["time_of_day_vector"] == "array<double>" and types["out_degree"] == "bigint"


def test_sensors_outside_the_network_get_zeros(spark):
    gold = gold_features(readings(spark), edges(spark, NETWORK)).where("sensor_id = 5")
    assert values(gold.select(*COLUMNS[-9:]).distinct(), by=["pagerank"]) == [(0, 0, 0, 0.0, 0.0, 0.0, 0, 0.0, 0.0)]


def test_missing_history_is_zero_in_gold(spark):
    first = gold_features(readings(spark), edges(spark, NETWORK)).orderBy("sensor_id", "timestamp").first()
    assert (first["lag_1"], first["speed_change"], first["rolling_std_3"], first["percent_change"]) == (0, 0, 0, 0)
    assert first["traffic_trend"] == "Stable"


def test_text_ids_join_number_ids(spark):
    df = readings(spark).withColumn("sensor_id", F.col("sensor_id").cast("string"))
    gold = gold_features(df, edges(spark, NETWORK))
    assert dict(gold.dtypes)["sensor_id"] == "string"
    assert gold.where("sensor_id = '4'").first()["weighted_degree"] == 10.0


def test_tiebreak_is_not_a_feature(spark):
    df = readings(spark).withColumn("event_id", F.monotonically_increasing_id())
    cfg = GoldConfig(series=SeriesConfig(tiebreak="event_id"))
    assert gold_features(df, edges(spark, NETWORK), cfg).columns == COLUMNS
    assert "event_id" not in scaled_inputs(series_frame(df, cfg.series), "event_id")


def test_scaled_vectors_can_be_kept(spark):
    cfg = GoldConfig(series=SeriesConfig(keep_scaled=True))
    gold = gold_features(readings(spark), edges(spark, NETWORK), cfg)
    assert {"scaled_features", "features"} < set(gold.columns) and "numeric_features" not in gold.columns
    row = gold.agg(F.min(F.array_min("scaled_features")), F.max(F.array_max("scaled_features"))).first()
    assert tuple(row) == (0.0, 1.0)


def test_feature_vector_is_33_scaled_numbers_and_the_flags(spark):
    df = readings(spark)
    built = build_series_features(df)
    assert len(scaled_inputs(series_frame(df))) == 33
    flags = sum(
        built.select(f"{c}_vector").first()[0].size
        for c in ("time_of_day", "congestion_level", "speed_category", "traffic_trend")
    )
    assert built.first()["features"].size == 33 + flags
    assert built.first()["numeric_features"].size == 33


def test_fitting_on_other_rows(spark):
    df = readings(spark)
    early = series_frame(df).where(F.col("timestamp") < F.lit(at(300)))
    built = build_series_features(df, fit_df=early)
    highest = built.where(F.col("timestamp") < F.lit(at(300))).select("scaled_features").collect()
    assert max(max(r[0].toArray()) for r in highest) == pytest.approx(1.0)
    assert max(max(r[0].toArray()) for r in built.select("scaled_features").collect()) > 1.0


def test_series_needs_its_columns(spark):
    with pytest.raises(ValueError, match="speed"):
        build_series_features(readings(spark).drop("speed"))


def test_a_hot_sensor_does_not_change_gold(spark):
    rows = [(1, at(i), float(i % 83)) for i in range(400)] + [(2, at(7 * i), float(i)) for i in range(40)]
    df = speeds(spark, rows)
    whole = gold_features(df, edges(spark, NETWORK))
    cut = gold_features(df, edges(spark, NETWORK), GoldConfig(series=SeriesConfig(rows_per_task=50)))
    scalars = [c for c in COLUMNS if not c.endswith("_vector")]
    assert values(whole, *scalars, by=["sensor_id", "timestamp"]) == values(
        cut, *scalars, by=["sensor_id", "timestamp"]
    )


def test_gold_plan(spark):
    text = plan(gold_features(readings(spark), edges(spark, NETWORK)))
    assert text.count("Exchange hashpartitioning") == 1  # one shuffle of the readings
    assert "BroadcastHashJoin" in text and "Python" not in text


def test_columns_that_exist_are_replaced(spark):
    df = readings(spark).withColumns({"hour": F.lit(99), "lag_1": F.lit(-1.0), "lane": F.lit(2)})
    frame = series_frame(df)
    assert frame.columns[:4] == ["sensor_id", "timestamp", "speed", "lane"]
    assert frame.agg(F.max("hour"), F.min("lag_1")).first()[0] < 24
    assert len(frame.columns) == len(set(frame.columns))
