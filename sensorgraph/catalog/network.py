"""Queries of the graph operators, the panel operators, the forecasts and the gold table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorgraph.catalog import fixtures as fx
from sensorgraph.catalog import sqltext as st
from sensorgraph.catalog.registry import query, r, rounded
from sensorgraph.catalog.series import series_range, series_sql, shown
from sensorgraph.config import GoldConfig, SequenceConfig, SeriesConfig
from sensorgraph.functions.labels import LABEL_COLUMNS
from sensorgraph.operators import forecast, graph, panel, reshape, series
from sensorgraph.operators.encode import standard_scale
from sensorgraph.operators.storage import scratch_path, stored
from sensorgraph.plans.features import build_graph_features, gold_features
from sensorgraph.sources import shards
from sensorgraph.sources.tables import export_csv, read_features_csv

SEQ = SequenceConfig()
END_ROUNDED = ("out_weight_degree", "in_weight_degree", "weighted_degree", "avg_neighbor_weight")


def _end_query(name, edges, *cols):
    picked = ", ".join(r(c, c) if c in END_ROUNDED else c for c in cols)

    @query(name, fx.with_views(f"select sensor_id, {picked} from ends", ends=st.end_view(edges)))
    def run(spark, sf):
        return rounded(graph.edge_end_features(getattr(fx, edges)(spark, sf)).select("sensor_id", *cols))


_end_query("g01_degrees", "sensor_edges", "out_degree", "in_degree", "degree")
_end_query(
    "g02_weighted_degrees", "sensor_edges", "out_weight_degree", "in_weight_degree", "weighted_degree"
)
_end_query("g03_neighbours", "sensor_edges", "neighbor_count", "avg_neighbor_weight")
_end_query("g03_supply_neighbours", "supply_edges", *graph.END_DEFAULTS)


@query(
    "g04_vertices",
    fx.with_views(
        "select source_sensor as sensor_id from supply_edges union select destination_sensor from supply_edges"
    ),
)
def g04(spark, sf):
    return graph.vertices(fx.supply_edges(spark, sf))


@query(
    "g05_transitions",
    fx.with_views(
        f"select a as source_sensor, b as destination_sensor, {r('p', 'transition')} from step",
        **{k: v for k, v in st.rank_views("sensor_edges", 0).items() if k in ("pair", "step")},
    ),
)
def g05(spark, sf):
    return rounded(graph.transitions(fx.sensor_edges(spark, sf)))


def _rank_query(name, edges, **options):
    last = f"rank_{st.ITERATIONS}"

    @query(
        name, fx.with_views(f"select s as sensor_id, {r('r', 'pagerank')} from {last}", **st.rank_views(edges))
    )
    def run(spark, sf):
        return rounded(graph.pagerank(getattr(fx, edges)(spark, sf), **options))


_rank_query("g06_pagerank", "sensor_edges")
_rank_query("g06_pagerank_dangling", "supply_edges")
# The way beyond the broadcast limit, with the links of most sensors spread over several slots.
SPREAD = {"broadcast_rows": 0, "links_per_slot": 20}
_rank_query("g06_pagerank_spread", "sensor_edges", **SPREAD)

GRAPH_SQL = ", ".join(r(f"g.{c}", c) if c in END_ROUNDED else f"g.{c}" for c in graph.END_DEFAULTS)


@query(
    "g07_graph_features",
    fx.with_views(
        f"select g.sensor_id, {GRAPH_SQL}, {r('r', 'pagerank')} from ends g join rank_{st.ITERATIONS} on s = g.sensor_id",
        ends=st.end_view("sensor_edges"),
        **st.rank_views("sensor_edges"),
    ),
)
def g07(spark, sf):
    return rounded(build_graph_features(fx.sensor_edges(spark, sf)))


def _propagate_query(name, **options):
    @query(
        name,
        fx.with_views(
            f"select timestamp, b as sensor_id, {r('sum(speed * k)', 'speed')} from speed_hourly "
            "join link on a = sensor_id group by timestamp, b",
            **st.link_views("sensor_edges"),
        ),
    )
    def run(spark, sf):
        readings, edges = fx.speed_hourly(spark, sf), fx.sensor_edges(spark, sf)
        return rounded(graph.propagate(readings, edges, ["speed"], **options))


_propagate_query("g08_propagate")
_propagate_query("g08_propagate_spread", **SPREAD)


@query(
    "g08_propagate_two_hops",
    fx.with_views(
        f"select timestamp, b as sensor_id, {r('sum(speed * k)', 'speed')} from hop "
        "join link on a = sensor_id group by timestamp, b",
        **st.link_views("trade_edges"),
        hop="select timestamp, b as sensor_id, sum(speed * k) as speed from speed_hourly "
        "join link on a = sensor_id group by timestamp, b",
    ),
)
def g08_hops(spark, sf):
    return rounded(
        graph.propagate(fx.speed_hourly(spark, sf), fx.trade_edges(spark, sf), ["speed"], hops=2)
    )


GOLD_SQL = ", ".join(
    [r(f"coalesce(g.{c}, 0)", c) if c in END_ROUNDED else f"coalesce(g.{c}, 0) as {c}" for c in graph.END_DEFAULTS]
    + [r(f"coalesce(rank_{st.ITERATIONS}.r, 0)", "pagerank")]
)


@query(
    "j07_gold",
    fx.with_views(
        f"select {series_sql('filled')}, {GOLD_SQL} from filled {st.label_joins(LABEL_COLUMNS, 'filled')} "
        f"left join ends g on g.sensor_id = filled.sensor_id "
        f"left join rank_{st.ITERATIONS} on rank_{st.ITERATIONS}.s = filled.sensor_id",
        **st.frame_views(),
        **st.label_views("frame", LABEL_COLUMNS),
        ends=st.end_view("sensor_edges"),
        **st.rank_views("sensor_edges"),
    ),
)
def j07(spark, sf):
    return shown(gold(spark, sf))


def gold(spark, sf):
    cfg = GoldConfig(series=SeriesConfig(tiebreak="event_id"))
    return gold_features(fx.speed_long(spark, sf), fx.sensor_edges(spark, sf), cfg)


IDS_ONLY = {"ids": st.panel_views("speed_hourly")["ids"]}
TIMES_ONLY = {"times": st.panel_views("speed_hourly")["times"]}


@query("n01_node_ids", fx.with_views("select * from ids", **IDS_ONLY))
def n01(spark, sf):
    return panel.node_ids(fx.sensor_edges(spark, sf))


@query(
    "j09_id_lookup",
    fx.with_views(
        """select source_sensor, destination_sensor, weight, a.node_id as source_node,
        b.node_id as destination_node from sensor_edges
        join ids a on a.sensor_id = source_sensor join ids b on b.sensor_id = destination_sensor""",
        **IDS_ONLY,
    ),
)
def j09(spark, sf):
    edges = fx.sensor_edges(spark, sf)
    return panel.edge_node_ids(edges, panel.node_ids(edges))


@query(
    "j09_fact_lookup",
    fx.with_views("select speed_long.*, node_id from speed_long join ids using (sensor_id)", **IDS_ONLY),
)
def j09_facts(spark, sf):
    ids = panel.node_ids(fx.sensor_edges(spark, sf))
    return panel.with_node_id(fx.speed_long(spark, sf), ids)


@query("n02_time_index", fx.with_views("select * from times", **TIMES_ONLY))
def n02(spark, sf):
    return panel.time_index(fx.speed_hourly(spark, sf))


# Hour-stamped single readings: several rows per cell, of which the last event wins.
STAMPED = """select user_id as sensor_id, cast(date_trunc('hour', ts) as timestamp) as timestamp,
    value as speed, event_id from events"""


def stamped(spark, sf):
    hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
    return fx.speed_long(spark, sf).withColumn("timestamp", hour)


N03_SQL = fx.with_views(
    """select t.timestamp, i.sensor_id, t.time_index, i.node_id, coalesce(c.speed, 0) as speed
    from times t cross join ids i left join cells c
    on c.timestamp = t.timestamp and c.sensor_id = i.sensor_id""",
    cells=f"select sensor_id, timestamp, arg_max(speed, event_id) as speed from ({STAMPED}) group by all",
    **{k: v for k, v in st.panel_views("cells").items() if k != "panel"},
)


def _panel_query(name, **options):
    @query(name, N03_SQL)
    def run(spark, sf):
        readings = stamped(spark, sf)
        times, ids = panel.time_index(readings), panel.node_ids(fx.sensor_edges(spark, sf))
        return panel.dense_panel(readings, ["speed"], tiebreak="event_id", times=times, ids=ids, **options)


_panel_query("n03_dense_panel")
# The way with more times and sensors than are broadcast, in spans of 50 steps.
_panel_query("n03_dense_panel_spread", broadcast_rows=0, steps_per_task=50)


PANEL_VIEWS = {"hourly_target": st.HOURLY_TARGET, **st.panel_views("hourly_target")}
CUT = f"(select cast(floor(count(*) * {SEQ.train_fraction}) as bigint) from times)"
SPLIT_VIEWS = PANEL_VIEWS | {
    "parted": f"select *, case when time_index < {CUT} then 'train' else 'validation' end as split from panel"
}


def hourly_target(spark, sf):
    # One row per sensor and hour: the length of a series is bounded by the hours covered.
    return series.next_target(fx.speed_hourly(spark, sf), rows_per_task=None)


def dense(spark, sf, edges=None):
    """The dense hourly panel with its targets, and the times it covers."""
    readings = hourly_target(spark, sf)
    edges = fx.sensor_edges(spark, sf) if edges is None else edges
    times, ids = panel.time_index(readings), panel.node_ids(edges)
    cols = ["speed", panel.pick_target(readings)]
    return panel.dense_panel(readings, cols, times=times, ids=ids), times


@query("n04_target", fx.with_views(f"select sensor_id, timestamp, {r('target_speed', 'target')} from hourly_target", hourly_target=st.HOURLY_TARGET))
def n04(spark, sf):
    readings = hourly_target(spark, sf)
    return rounded(readings.select("sensor_id", "timestamp", F.col(panel.pick_target(readings)).alias("target")))


@query(
    "n05_split",
    fx.with_views(f"select timestamp, sensor_id, time_index, node_id, {r('speed', 'speed')}, {r('target_speed', 'target_speed')}, split from parted", **SPLIT_VIEWS),
)
def n05(spark, sf):
    cells, times = dense(spark, sf)
    return rounded(panel.chrono_split(cells, SEQ.train_fraction, times=times))


def sequence_view(source: str, parts: str, cols=("speed",)) -> dict[str, str]:
    order = f"partition by {parts} order by time_index"
    steps = [
        f"{c} as {c}_sequence_0" if k == 0 else f"lead({c}, {k}) over ({order}) as {c}_sequence_{k}"
        for c in cols
        for k in range(SEQ.length)
    ]
    return {
        "seq": f"select *, {', '.join(steps)}, lead(target_speed, {SEQ.horizon}) over ({order}) as target, "
        f"lead(time_index, {SEQ.horizon}) over ({order}) as target_index from {source}"
    }


STEP_SQL = ", ".join(r(f"speed_sequence_{k}", f"speed_sequence_{k}") for k in range(SEQ.length))
STEP_WIDTHS = {"speed_sequence": SEQ.length}


def sequences(spark, sf, split=True, cols=("speed",), steps_per_task=SEQ.steps_per_task):
    cells, times = dense(spark, sf)
    if split:
        cells = panel.chrono_split(cells, SEQ.train_fraction, times=times)
    return panel.sequences(
        cells, SEQ.length, SEQ.horizon, "split" if split else None,
        cols=cols, steps_per_task=steps_per_task,
    )


SEQUENCE_SQL = (
    fx.with_views(
        f"select node_id, sensor_id, timestamp, time_index, {STEP_SQL}, {r('target', 'target')} "
        "from seq where target_index is not null",
        **PANEL_VIEWS,
        **sequence_view("panel", "sensor_id"),
    )
)


def _sequence_query(name, steps_per_task):
    @query(name, SEQUENCE_SQL)
    def run(spark, sf):
        found = sequences(spark, sf, split=False, steps_per_task=steps_per_task)
        return rounded(reshape.flatten_arrays(found, STEP_WIDTHS))


_sequence_query("w08_sequences", SEQ.steps_per_task)
_sequence_query("w08_sequences_in_spans", 50)


@query(
    "n06_split_sequences",
    fx.with_views(
        f"select node_id, sensor_id, split, timestamp, time_index, {STEP_SQL}, {r('target', 'target')} "
        "from seq where target_index is not null",
        **SPLIT_VIEWS,
        **sequence_view("parted", "split, sensor_id"),
    ),
)
def n06(spark, sf):
    return rounded(reshape.flatten_arrays(sequences(spark, sf), STEP_WIDTHS))


@query(
    "n07_clean",
    fx.with_views(
        """select sensor_id, timestamp, coalesce(speed, 0) as speed, event_id::double as event_id,
        0.0::double as kind, coalesce(try_cast(reading as double), 0) as reading from (
            select user_id as sensor_id, ts as timestamp, event_id,
            case when event_type <> 'error' then value end as speed, event_type as kind,
            case when event_type = 'error' then 'n/a' else cast(value as varchar) end as reading from events)"""
    ),
)
def n07(spark, sf):
    raw = fx.table(spark, sf, "events")
    reading = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    texts = raw.select(
        F.col("user_id").alias("sensor_id"), F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("speed"), "event_id",
        F.col("event_type").alias("kind"), reading.alias("reading"),
    )
    return panel.clean_features(texts)


@query(
    "n07_scaled",
    fx.with_views(
        f"select sensor_id, timestamp, {r('(speed - avg(speed) over ()) / stddev_pop(speed) over ()', 'speed')} from "
        "(select sensor_id, timestamp, coalesce(speed, 0) as speed from speed_nullable)"
    ),
)
def n07_scaled(spark, sf):
    cleaned = panel.clean_features(fx.speed_nullable(spark, sf).drop("event_id"))
    return rounded(standard_scale(cleaned, reshape.numeric_columns(cleaned, ["sensor_id"])))


N08_SQL = fx.with_views(
    f"select timestamp, time_index, node_id, {r('speed', 'speed')}, {r('target_speed', 'target_speed')} from panel",
    **PANEL_VIEWS,
)


def _written_shards(spark, sf):
    """The dense hourly panel in shards of 100 steps by 64 nodes, speeds scaled."""
    path = scratch_path(spark, "shards")
    cells = stored(dense(spark, sf)[0], "panel")
    shards.write_shards(cells, path, ["speed", "target_speed"], {"speed": (40.0, 25.0)}, times_per_shard=100, nodes_per_shard=64)
    return path


@query("n08_shards", N08_SQL)
def n08_shards(spark, sf):
    cells = shards.read_shards(spark, _written_shards(spark, sf))
    return rounded(cells.select("timestamp", "time_index", "node_id", "speed", "target_speed"))


@query("w08_sequences_from_shards", SEQUENCE_SQL)
def w08_shards(spark, sf):
    found = shards.shard_sequences(spark, _written_shards(spark, sf), SEQ.length, SEQ.horizon)
    return rounded(reshape.flatten_arrays(found, STEP_WIDTHS))


@query("n08_snapshots", N08_SQL)
def n08(spark, sf):
    cells, _ = dense(spark, sf)
    arrays = panel.snapshots(cells, ["speed", "target_speed"], nodes_per_block=64)
    # Back to rows, with the node read off the position in the arrays.
    return rounded(
        arrays.select(
            "timestamp", "time_index", "block", F.posexplode(F.arrays_zip("speed", "target_speed"))
        ).select(
            "timestamp", "time_index", (F.col("block") * 64 + F.col("pos")).alias("node_id"),
            "col.speed", "col.target_speed",
        )
    )


FORECAST_VIEWS = {
    **SPLIT_VIEWS,
    **sequence_view("parted", "split, sensor_id"),
    "forecast": f"""select time_index, node_id, target as actual, speed_sequence_{SEQ.length - 1} as predicted
        from seq where target_index is not null and split = 'validation'""",
}


def persisted(spark, sf):
    return forecast.persistence(sequences(spark, sf).where(F.col("split") == "validation"))


@query(
    "m02_persistence",
    fx.with_views(
        f"select time_index, node_id, {r('actual', 'actual')}, {r('predicted', 'predicted')} from forecast",
        **FORECAST_VIEWS,
    ),
)
def m02(spark, sf):
    return rounded(persisted(spark, sf).select("time_index", "node_id", "actual", "predicted"))


def _metric_query(name, metric, expression):
    @query(name, fx.with_views(f"select {r(expression, metric)} from forecast", **FORECAST_VIEWS))
    def run(spark, sf):
        return rounded(forecast.regression_metrics(persisted(spark, sf)).select(metric))


_metric_query("m03_rmse", "rmse", "sqrt(avg(pow(actual - predicted, 2)))")
_metric_query("m04_mae", "mae", "avg(abs(actual - predicted))")
_metric_query(
    "m05_huber",
    "huber",
    """avg(case when abs(actual - predicted) <= 1 then 0.5 * pow(actual - predicted, 2)
        else abs(actual - predicted) - 0.5 end)""",
)


@query(
    "m06_actual_vs_predicted",
    fx.with_views(
        f"select time_index, node_id, {r('actual', 'actual')}, {r('predicted', 'predicted')} from forecast "
        "order by time_index, node_id limit 20",
        **FORECAST_VIEWS,
    ),
)
def m06(spark, sf):
    return rounded(forecast.actual_vs_predicted(persisted(spark, sf)))


def _forecast(spark, sf, kind):
    """Errors on the validation times of a model fitted on the training times, next to persistence."""
    edges = stored(fx.sensor_edges(spark, sf), "edges")
    cells, times = dense(spark, sf, edges)
    cells = stored(cells, "panel")
    near = graph.propagate(cells, edges, ["speed"]).withColumnRenamed("speed", "neighbor_speed")
    joined = reshape.fill_zero(cells.join(near, ["timestamp", "sensor_id"], "left"), ["neighbor_speed"])
    parted = panel.chrono_split(joined, SEQ.train_fraction, times=times)
    inputs = ["speed", "neighbor_speed"]
    samples = panel.sequences(parted, SEQ.length, SEQ.horizon, "split", cols=inputs)
    widths = {f"{c}_sequence": SEQ.length for c in inputs}
    # Written as arrays: neighbouring windows share all steps but one, which files compress and flat columns do not.
    flat = reshape.flatten_arrays(stored(samples.withColumnRenamed("target", "actual"), "samples"), widths)
    features = [f"{c}_{k}" for c, width in widths.items() for k in range(width)]
    train = flat.where(F.col("split") == "train")
    validation = flat.where(F.col("split") == "validation")
    predicted = forecast.fit_forecaster(train, features, kind).transform(validation)
    error = lambda guess: F.sqrt(F.avg(F.pow(F.col("actual") - F.col(guess), 2)))
    facts = predicted.agg(
        F.count("*").alias("samples"), F.sum("actual").alias("actual_sum"), F.avg("actual").alias("actual_mean"),
        (error("predicted") < error(f"speed_sequence_{SEQ.length - 1}")).alias("better"),
    )
    named = F.array(*[F.struct(F.lit(n).alias("forecaster"), b.alias("beats_persistence")) for n, b in ((kind, F.col("better")), ("persistence", F.lit(False)))])
    found = facts.select(F.inline(named), "samples", "actual_sum", "actual_mean")
    return rounded(found, actual_sum=4)


def _forecast_query(name, kind):
    facts = f"count(*) as samples, {r('sum(actual)', 'actual_sum', 4)}, {r('avg(actual)', 'actual_mean')} from forecast"
    body = f"select '{kind}' as forecaster, true as beats_persistence, {facts} union all "
    body += f"select 'persistence' as forecaster, false as beats_persistence, {facts}"

    @query(name, fx.with_views(body, **FORECAST_VIEWS))
    def run(spark, sf):
        """Samples of the validation times, and whether the model errs less than the last value does."""
        return _forecast(spark, sf, kind)


_forecast_query("m01_forecast", "huber")
_forecast_query("m01_forecast_trees", "gbt")


MASKED_VIEWS = {**PANEL_VIEWS, "masked": PANEL_VIEWS["panel"].replace("coalesce(c.speed, 0)", "c.speed")}


@query(
    "n03_masked_panel",
    fx.with_views(f"select timestamp, sensor_id, time_index, node_id, {r('speed', 'speed')} from masked", **MASKED_VIEWS),
)
def n03_masked(spark, sf):
    readings = hourly_target(spark, sf)
    times, ids = panel.time_index(readings), panel.node_ids(fx.sensor_edges(spark, sf))
    return rounded(panel.dense_panel(readings, ["speed"], mask_missing=True, times=times, ids=ids))


@query(
    "n06_near_horizon",
    fx.with_views(
        f"select node_id, timestamp, {r('target', 'target')} from (select node_id, timestamp, "
        "lead(target_speed, 3) over w as target, lead(time_index, 3) over w as t3, "
        f"lead(time_index, {SEQ.length - 1}) over w as last from panel window w as (partition by sensor_id order by time_index)) "
        "where t3 is not null and last is not null",
        **PANEL_VIEWS,
    ),
)
def n06_near(spark, sf):
    """The target three steps after the first instead of twelve."""
    cells, _ = dense(spark, sf)
    return rounded(panel.sequences(cells, SEQ.length, 3).select("node_id", "timestamp", "target"))


@query(
    "g05_transitions_without_weight",
    """with e as (select o_custkey as a, l_suppkey + 1000000000 as b,
            case when o_custkey % 3 = 0 then 0 else l_quantity end as w
            from lineitem join orders on l_orderkey = o_orderkey),
        p as (select a, b, sum(w) as w from e group by all)
    select a as source_sensor, b as destination_sensor,
        round(coalesce(w / nullif(sum(w) over (partition by a), 0), 0) + 0.000000001::double, 6) as transition from p""",
)
def g05_zero(spark, sf):
    """A third of the sources pass on no weight; all their transitions are 0."""
    weight = F.when(F.col("source_sensor") % 3 == 0, F.lit(0).cast("double")).otherwise(F.col("weight").cast("double"))
    return rounded(graph.transitions(fx.supply_edges(spark, sf).withColumn("weight", weight)))


@query(
    "j07_gold_scaled",
    fx.with_views(
        "select filled.sensor_id, filled.timestamp, "
        + ", ".join(r(series_range(c), f"scaled_features_{i}", 5) for i, c in enumerate(st.SCALED))
        + ", "
        + ", ".join(
            r(e, f"features_{i}", 5)
            for i, e in enumerate(
                [series_range(c) for c in st.SCALED]
                + [f"(idx_{c}.i = {k})::int::double" for c, width in st.LABEL_WIDTHS.items() for k in range(width)]
            )
        )
        + f", {GOLD_SQL} from filled {st.label_joins(LABEL_COLUMNS, 'filled')} left join ends g on g.sensor_id = filled.sensor_id "
        + f"left join rank_{st.ITERATIONS} on rank_{st.ITERATIONS}.s = filled.sensor_id",
        **st.frame_views(),
        **st.label_views("frame", LABEL_COLUMNS),
        ends=st.end_view("sensor_edges"),
        **st.rank_views("sensor_edges"),
    ),
)
def j07_scaled(spark, sf):
    """Gold with the scaled and assembled vectors, as arrays."""
    cfg = GoldConfig(series=SeriesConfig(tiebreak="event_id", keep_scaled=True))
    built = gold_features(fx.speed_long(spark, sf), fx.sensor_edges(spark, sf), cfg)
    widths = {"scaled_features": len(st.SCALED), "features": len(st.SCALED) + sum(st.LABEL_WIDTHS.values())}
    arrays = built.select("sensor_id", "timestamp", *widths, *graph.GRAPH_DEFAULTS)
    made = [f"{c}_{i}" for c, width in widths.items() for i in range(width)]
    return rounded(reshape.flatten_arrays(arrays, widths), **dict.fromkeys(made, 5))


# Speeds of six hours, as many of them as a model reads: one row per sensor and step.
SIX_HOURLY = """select user_id as sensor_id, 0::bigint as event_id,
    cast(date_trunc('day', ts) + (hour(ts) // 6 * 6) * interval 1 hour as timestamp) as timestamp, avg(value) as speed from events group by all"""
GOLD_LABELS = [f"{c}_index" for c in LABEL_COLUMNS]
GOLD_FLAGS = [f"{c}_vector_{k}" for c, width in st.LABEL_WIDTHS.items() for k in range(width)]
GOLD_NUMBERS = ["speed", "target_speed", *st.SCALED, *GOLD_LABELS, *GOLD_FLAGS, *graph.END_DEFAULTS, "pagerank"]
# What is no number in the file: text that cleaning makes 0.
GOLD_TEXTS = ["date", *LABEL_COLUMNS]
MODEL_INPUTS = [*GOLD_NUMBERS, *GOLD_TEXTS]


def _gold_sequence_sql() -> str:
    order = "partition by p.sensor_id order by time_index"
    scaled = [f"case when min({c}) over () = max({c}) over () then 0 else ({c} - avg({c}) over ()) / stddev_pop({c}) over () end as {c}" for c in GOLD_NUMBERS]
    weighed = lambda c: " + ".join(f"{k + 1} * lead({c}, {k}) over w" for k in range(SEQ.length))
    views = {
        "six_hourly": SIX_HOURLY,
        **st.frame_views("six_hourly"),
        **st.label_views("frame", LABEL_COLUMNS),
        "ends": st.end_view("sensor_edges"),
        **st.rank_views("sensor_edges"),
        "gold": "select filled.sensor_id, filled.timestamp, speed, target_speed, "
        + ", ".join(f"filled.{c}" for c in st.SCALED) + ", "
        + ", ".join(f"idx_{c}.i as {c}_index" for c in LABEL_COLUMNS) + ", "
        + ", ".join(f for c, width in st.LABEL_WIDTHS.items() for f in st.label_flags(c, width)) + ", "
        + ", ".join(f"coalesce(g.{c}, 0) as {c}" for c in graph.END_DEFAULTS)
        + f", coalesce(rank_{st.ITERATIONS}.r, 0) as pagerank from filled {st.label_joins(LABEL_COLUMNS, 'filled')} "
        + f"left join ends g on g.sensor_id = filled.sensor_id left join rank_{st.ITERATIONS} on rank_{st.ITERATIONS}.s = filled.sensor_id",
        "scaled": f"select sensor_id, timestamp, {', '.join(scaled)} from gold",
        "times": "select timestamp, row_number() over (order by timestamp) - 1 as time_index from (select distinct timestamp from scaled)",
        "ids": st.panel_views("scaled")["ids"],
        "grid": "select t.timestamp, i.sensor_id, t.time_index, i.node_id, "
        + ", ".join(f"coalesce(c.{c}, 0) as {c}" for c in GOLD_NUMBERS)
        + " from times t cross join ids i left join scaled c on c.timestamp = t.timestamp and c.sensor_id = i.sensor_id",
        "moving": "select node_id, p.sensor_id, timestamp, time_index, "
        + ", ".join(f"{weighed(c)} as {c}" for c in GOLD_NUMBERS)
        + f", lead(target_speed, {SEQ.horizon}) over w as target, lead(time_index, {SEQ.horizon}) over w as target_index from grid p window w as ({order})",
    }
    # The nested calls turn a rounded -0.0 into 0.0.
    tidy = lambda c, name, digits: f"coalesce(nullif(round({c} + 1e-9::double, {digits}), 0), 0) as {name}"
    picked = ", ".join(tidy(c, f"{c}_sequence", 2 if "std" in c else 4) for c in GOLD_NUMBERS)
    none = ", ".join(f"0.0::double as {c}_sequence" for c in GOLD_TEXTS)
    return fx.with_views(f"select node_id, sensor_id, timestamp, time_index, {picked}, {none}, {tidy('target', 'target', 4)} from moving where target_index is not null", **views)


@query("n09_gold_to_sequences", _gold_sequence_sql())
def n09(spark, sf):
    """From gold to model input: a CSV file, cleaned, scaled, dense, in sequences of all columns.

    A sequence is shown as the sum of its steps, each times its place, which tells any value and any order apart.
    """
    step = (F.date_trunc("day", "ts") + F.make_dt_interval(F.lit(0), (F.hour("ts") / 6).cast("int") * 6)).cast("timestamp_ntz")
    events = fx.table(spark, sf, "events")
    speeds = events.groupBy(F.col("user_id").alias("sensor_id"), step.alias("timestamp")).agg(F.avg("value").alias("speed"), F.lit(0).cast("long").alias("event_id"))
    edges = stored(fx.sensor_edges(spark, sf), "edges")
    built = gold_features(stored(speeds, "six-hourly"), edges, GoldConfig(series=SeriesConfig(tiebreak="event_id")))
    path = scratch_path(spark, "gold-csv")
    export_csv(built, path, {f"{c}_vector": width for c, width in st.LABEL_WIDTHS.items()})
    kinds = ["sensor_id long", "timestamp timestamp_ntz", *[f"{c} double" for c in GOLD_NUMBERS], *[f"{c} string" for c in GOLD_TEXTS]]
    cleaned = panel.clean_features(read_features_csv(spark, path, ", ".join(kinds)))
    scaled = stored(standard_scale(stored(cleaned, "cleaned"), MODEL_INPUTS), "model-input")
    times, ids = panel.time_index(scaled), panel.node_ids(edges)
    cells = panel.dense_panel(scaled, MODEL_INPUTS, times=times, ids=ids)
    found = panel.sequences(cells, SEQ.length, SEQ.horizon, cols=MODEL_INPUTS)
    # Element by element: functions over arrays are interpreted, and there are 12 steps of every column in every row.
    step_of = lambda c, i: F.get(f"{c}_sequence", F.lit(i)) * (i + 1)
    total = lambda c: reduce(Column.__add__, [step_of(c, i) for i in range(SEQ.length)], F.lit(0.0))
    shown_ = found.select("node_id", "sensor_id", "timestamp", "time_index", *[total(c).alias(f"{c}_sequence") for c in MODEL_INPUTS], "target")
    return rounded(shown_, 4, **{f"{c}_sequence": 2 for c in MODEL_INPUTS if "std" in c})
