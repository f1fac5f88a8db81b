import random

import pytest
from pyspark.sql import functions as F

from sensorgraph.operators import forecast, panel
from tests.helpers import at, edges, plan, speeds, values


def test_dense_index_counts_across_partitions(spark):
    numbers = random.Random(1).sample(range(10_000), 700)
    df = spark.createDataFrame([(n,) for n in numbers], "k long").repartition(5)
    found = {r["k"]: r["i"] for r in panel.dense_index(df, ["k"], "i").collect()}
    assert found == {k: i for i, k in enumerate(sorted(numbers))}


def test_dense_index_of_text_and_of_nothing(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert values(panel.dense_index(df, ["k"], "i"), by=["k"]) == [("a", 0), ("b", 1), ("c", 2)]
    assert panel.dense_index(df.where("k = 'z'"), ["k"], "i").count() == 0


def test_node_ids_follow_sensor_order(spark):
    ids = panel.node_ids(edges(spark, [(30, 10, 1.0), (10, 20, 1.0)]))
    assert values(ids, by=["sensor_id"]) == [(10, 0), (20, 1), (30, 2)]


def test_edge_node_ids(spark):
    df = edges(spark, [(30, 10, 1.0), (10, 20, 2.0)])
    looked_up = panel.edge_node_ids(df, panel.node_ids(df))
    assert values(looked_up, "source_node", "destination_node", "weight", by=["weight"]) == [
        (2, 0, 1.0), (0, 1, 2.0)
    ]


def test_node_ids_drop_unknown_sensors(spark):
    ids = panel.node_ids(edges(spark, [(1, 2, 1.0)]))
    df = speeds(spark, [(1, at(0), 5.0), (9, at(0), 6.0)])
    assert values(panel.with_node_id(df, ids), "sensor_id", "node_id", by=["sensor_id"]) == [(1, 0)]


@pytest.fixture(scope="module")
def grid(spark):
    """Three times, two nodes, one duplicate cell and one cell without a reading."""
    schema = "sensor_id long, timestamp timestamp_ntz, speed double, target_speed double, event_id long"
    rows = [
        (1, at(0), 1.0, 2.0, 1), (1, at(5), 2.0, 3.0, 2), (1, at(10), 3.0, 4.0, 3),
        (2, at(0), 9.0, 9.0, 4), (2, at(0), 5.0, 6.0, 5), (2, at(10), 7.0, None, 6),
    ]
    readings = speeds(spark, rows, schema)
    ids = panel.node_ids(edges(spark, [(1, 2, 1.0)]))
    return readings, panel.time_index(readings), ids


def panel_of(grid, cols, **options):
    readings, times, ids = grid
    return panel.dense_panel(readings, cols, times=times, ids=ids, **options)


CELLS = ["time_index", "node_id", "speed", "target_speed"]


def test_dense_panel_last_row_wins_and_gaps_are_zero(grid):
    df = panel_of(grid, ["speed", "target_speed"], tiebreak="event_id")
    assert values(df, *CELLS, by=["time_index", "node_id"]) == [
        (0, 0, 1.0, 2.0), (0, 1, 5.0, 6.0), (1, 0, 2.0, 3.0), (1, 1, 0.0, 0.0),
        (2, 0, 3.0, 4.0), (2, 1, 7.0, 0.0),
    ]


def test_dense_panel_without_tiebreak_takes_whole_rows(grid):
    df = panel_of(grid, ["speed", "target_speed"])
    assert values(df.where("time_index = 0 and node_id = 1"), *CELLS, by=["node_id"]) == [(0, 1, 9.0, 9.0)]


def test_dense_panel_can_mask_missing_cells(grid):
    df = panel_of(grid, ["speed", "target_speed"], mask_missing=True, tiebreak="event_id")
    assert values(df.where("node_id = 1"), *CELLS, by=["time_index"]) == [
        (0, 1, 5.0, 6.0), (1, 1, None, None), (2, 1, 7.0, None)
    ]


def test_dense_panel_uses_no_cross_join(grid):
    text = plan(panel_of(grid, ["speed"]))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_only_readings_are_shuffled_for_the_panel(spark):
    """One exchange to pick a reading per cell, one by node and span; the steps between are filled behind them."""
    readings = speeds(spark, [(s, at(5 * t), 1.0) for s in range(3) for t in range(0, 40, 3)])
    df = panel.dense_panel(readings, ["speed"])
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 2
    assert "Exchange hashpartitioning(node_id" in text
    assert df.count() == 3 * 14


@pytest.mark.parametrize("steps_per_task", [1, 4, 100])
def test_dense_panel_in_spans(spark, steps_per_task):
    rows = [(s, at(t), float(s * 100 + t)) for s in range(3) for t in range(20) if (s + t) % 3 or t == 11]
    df = panel.dense_panel(speeds(spark, rows), ["speed"], steps_per_task=steps_per_task)
    known = {(s, t): v for s, t, v in rows}
    wanted = [(at(t), s, known.get((s, at(t)), 0.0)) for t in range(20) for s in range(3)]
    assert values(df, "timestamp", "sensor_id", "speed", by=["timestamp", "sensor_id"]) == wanted


def test_dense_panel_of_its_own_times_and_sensors(spark):
    df = panel.dense_panel(speeds(spark, [(7, at(0), 1.0), (3, at(5), 2.0)]), ["speed"])
    assert values(df, "sensor_id", *CELLS[:3], by=["time_index", "node_id"]) == [
        (3, 0, 0, 0.0), (7, 0, 1, 1.0), (3, 1, 0, 2.0), (7, 1, 1, 0.0)
    ]


def test_pick_target(grid):
    readings = grid[0]
    assert panel.pick_target(readings) == "target_speed"
    assert panel.pick_target(readings.drop("target_speed")) == "speed"


def dense(spark, steps, nodes):
    return spark.range(steps * nodes).select(
        (F.lit(at(0)) + F.make_dt_interval(mins=(F.col("id") % steps).cast("int"))).alias("timestamp"),
        (F.col("id") % steps).alias("time_index"),
        F.expr(f"id div {steps}").alias("node_id"),
        (F.expr(f"id div {steps}") + 100).alias("sensor_id"),
        F.when(F.col("id") % 17 != 0, F.col("id").cast("double")).alias("speed"),
        (F.col("id") * 2.0).alias("goal"),
    )


def brute_sequences(rows, length, horizon, parts):
    series, found = {}, {}
    for r in sorted(rows, key=lambda r: r["time_index"]):
        series.setdefault((r["node_id"], *(r[p] for p in parts)), []).append(r)
    for key, steps in series.items():
        for i in range(len(steps) - max(horizon, length - 1)):
            found[(*key, steps[i]["time_index"])] = (
                [s["speed"] for s in steps[i : i + length]], steps[i + horizon]["goal"]
            )
    return found


@pytest.mark.parametrize("steps_per_task", [5, 13, 30, 1000])
@pytest.mark.parametrize("length, horizon", [(12, 12), (3, 5), (5, 2)])
def test_sequences_equal_brute_force(spark, steps_per_task, length, horizon):
    df = dense(spark, 61, 3)
    found = panel.sequences(
        df, length, horizon, cols=["speed"], target="goal", steps_per_task=steps_per_task
    )
    assert {
        (r["node_id"], r["time_index"]): (r["speed_sequence"], r["target"]) for r in found.collect()
    } == brute_sequences(df.collect(), length, horizon, [])


def test_split_sequences_do_not_cross_the_cut(spark):
    df = dense(spark, 50, 2)
    times = df.select("timestamp", "time_index").distinct()
    parted = panel.chrono_split(df, 0.61, times=times)
    assert parted.exceptAll(panel.chrono_split(df, 0.61)).count() == 0
    assert parted.where("split = 'train'").agg(F.max("time_index")).first()[0] == int(50 * 0.61) - 1
    found = panel.sequences(parted, 4, 4, "split", target="goal", steps_per_task=7)
    assert {
        (r["node_id"], r["split"], r["time_index"]): (r["speed_sequence"], r["target"])
        for r in found.collect()
    } == brute_sequences(parted.collect(), 4, 4, ["split"])
    assert found.count() == (50 - 2 * 4) * 2


def test_sequence_of_target_column_only_once(spark):
    found = panel.sequences(dense(spark, 20, 1), 3, 3, cols=["goal"], target="goal")
    assert found.count() == 17 and found.columns[-2:] == ["goal_sequence", "target"]


def test_snapshots_in_blocks(spark):
    df = dense(spark, 2, 5)
    whole = panel.snapshots(df, ["goal"])
    assert values(whole, "time_index", "block", by=["time_index"]) == [(0, 0), (1, 0)]
    assert whole.where("time_index = 1").first()["goal"] == [2.0, 6.0, 10.0, 14.0, 18.0]
    parts = panel.snapshots(df, ["goal"], nodes_per_block=2).where("time_index = 1").orderBy("block")
    assert [r["goal"] for r in parts.collect()] == [[2.0, 6.0], [10.0, 14.0], [18.0]]


def test_clean_features(spark):
    df = spark.createDataFrame(
        [(1, at(0), " 3.5 ", "Free Flow", None, 2, [1.0]), (2, at(0), "1d", "1e2", 4.0, 5, [2.0])],
        "sensor_id long, timestamp timestamp_ntz, a string, b string, c double, d int, e array<double>",
    )
    assert values(panel.clean_features(df), "sensor_id", "a", "b", "c", "d", "e", by=["sensor_id"]) == [
        (1, 3.5, 0.0, 0.0, 2.0, 0.0), (2, 0.0, 100.0, 4.0, 5.0, 0.0)
    ]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.5), (0.0, -3.0)], "actual double, predicted double")
    assert values(forecast.regression_metrics(df), by=["rmse"]) == [
        (round((9.25 / 2) ** 0.5, 6), 1.75, round((0.125 + 2.5) / 2, 6))
    ]
    assert forecast.regression_metrics(df, delta=10).first()["huber"] == pytest.approx(9.25 / 4)


def test_persistence_takes_the_last_step(spark):
    found = forecast.persistence(panel.sequences(dense(spark, 6, 1), 2, 3, cols=["goal"], target="goal"), "goal")
    assert values(found, "actual", "predicted", by=["time_index"]) == [(6.0, 2.0), (8.0, 4.0), (10.0, 6.0)]


def test_actual_vs_predicted_is_ordered(spark):
    df = spark.createDataFrame(
        [(i % 7, i, float(i), 0.0) for i in range(50)], "time_index int, node_id int, actual double, predicted double"
    )
    rows = forecast.actual_vs_predicted(df, 10).collect()
    assert [(r["time_index"], r["node_id"]) for r in rows] == sorted((i % 7, i) for i in range(50))[:10]


@pytest.mark.parametrize("kind", ["huber", "gbt"])
def test_forecasters_learn_a_line(spark, kind):
    df = spark.range(200).select(
        (F.col("id") / 10).alias("a"), (F.col("id") % 3).cast("double").alias("b"),
        (F.col("id") / 5 + 1).alias("actual"),
    )
    found = forecast.fit_forecaster(df, ["a", "b"], kind).transform(df)
    assert forecast.regression_metrics(found).first()["mae"] < 1.0


def test_unknown_forecaster(spark):
    with pytest.raises(ValueError, match="huber"):
        forecast.fit_forecaster(spark.range(1), ["id"], "magic")


@pytest.mark.parametrize("steps", [1, 2, 7, 1000])
def test_panel_beyond_the_broadcast_limit_is_the_same(spark, steps):
    r = random.Random(steps)
    rows = [(r.randrange(6), at(r.randrange(40)), float(k), k) for k in range(120)]
    readings = speeds(spark, rows, "sensor_id long, timestamp timestamp_ntz, speed double, event_id long")
    by = ["time_index", "node_id"]
    small = panel.dense_panel(readings, ["speed"], True, "event_id")
    spread = panel.dense_panel(readings, ["speed"], True, "event_id", broadcast_rows=0, steps_per_task=steps)
    assert spread.columns == small.columns and values(spread, by=by) == values(small, by=by)
    times = len({row[1] for row in rows})
    assert spread.count() == times * len({row[0] for row in rows})


def test_filled_cells_are_not_shuffled(spark):
    readings = speeds(spark, [(k % 3, at(k), 1.0) for k in range(30)])
    times, ids = panel.time_index(readings), panel.dense_index(readings.select("sensor_id").distinct(), ["sensor_id"], "node_id")
    text = plan(panel.dense_panel(readings, ["speed"], times=times, ids=ids, broadcast_rows=0, steps_per_task=5))
    assert text.index("Generate posexplode") < text.index("Exchange")
    assert panel.dense_panel(readings.limit(0), ["speed"], broadcast_rows=0).count() == 0


def test_forecast_samples_are_stored_as_arrays(spark, monkeypatch):
    """Windows that overlap by all steps but one: as flat columns they would be written anew for every step."""
    from sensorgraph.catalog import network

    kinds, store = {}, network.stored
    monkeypatch.setattr(network, "stored", lambda df, name: kinds.update({name: dict(df.dtypes)}) or store(df, name))
    network._forecast(spark, "/root/testdata/sf0.001", "huber")
    assert [kinds["samples"][f"{c}_sequence"] for c in ("speed", "neighbor_speed")] == ["array<double>"] * 2


def test_shown_sequences_are_summed_without_interpreted_functions(spark):
    from sensorgraph.catalog import network

    assert "lambdafunction" not in plan(network.n09(spark, "/root/testdata/sf0.001"))
