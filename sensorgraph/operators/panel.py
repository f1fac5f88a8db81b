"""Dense time-by-sensor panels, sequences, splits and snapshots."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgraph.config import BROADCAST_ROWS, NODES_PER_BLOCK, STEPS_PER_TASK
from sensorgraph.functions.parsing import to_number
from sensorgraph.operators.graph import vertices
from sensorgraph.operators.reshape import fill_zero
from sensorgraph.operators.storage import fits_broadcast, stored


def dense_index(values: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """Numbers the (distinct) rows of ``values`` 0, 1, 2, ... in the order of ``by``.

    Rows are range-partitioned and sorted within partitions; a row's number is its position in its
    partition plus the rows of all earlier partitions. Only one count per partition reaches the driver.
    """
    placed = stored(
        values.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}),
        out.replace("_", "-"),
    )
    sizes = {r["__part"]: r["count"] for r in placed.groupBy("__part").count().collect()}
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    position = F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    offset = F.get(F.array(*[F.lit(s).cast("long") for s in starts or [0]]), F.col("__part"))
    return placed.select(*values.columns, (offset + position).alias(out))


def node_ids(edges: DataFrame, *, sensor: str = "sensor_id") -> DataFrame:
    """``(sensor, node_id)`` for the sensors of both edge ends, in ascending order."""
    return dense_index(vertices(edges, sensor=sensor), [sensor], "node_id")


def with_node_id(df: DataFrame, ids: DataFrame, *, sensor: str = "sensor_id") -> DataFrame:
    """Adds ``node_id``; rows of unknown sensors are dropped."""
    return df.join(ids, sensor)


def edge_node_ids(edges: DataFrame, ids: DataFrame, *, sensor: str = "sensor_id") -> DataFrame:
    """Adds ``source_node`` and ``destination_node``."""
    sources = ids.select(F.col(sensor).alias("source_sensor"), F.col("node_id").alias("source_node"))
    destinations = ids.select(
        F.col(sensor).alias("destination_sensor"), F.col("node_id").alias("destination_node")
    )
    return edges.join(sources, "source_sensor").join(destinations, "destination_sensor")


def time_index(df: DataFrame, *, time: str = "timestamp") -> DataFrame:
    """``(time, time_index)`` for the distinct times, in ascending order."""
    return dense_index(df.select(time).distinct(), [time], "time_index")


def pick_target(df: DataFrame, *, value: str = "speed") -> str:
    return "target_speed" if "target_speed" in df.columns else value


def dense_panel(
    df: DataFrame,
    cols: Sequence[str],
    mask_missing: bool = False,
    tiebreak: str | None = None,
    *,
    times: DataFrame | None = None,
    ids: DataFrame | None = None,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    steps_per_task: int = STEPS_PER_TASK,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per time of ``times`` and node of ``ids``; cells without a reading are 0.

    Only the readings are shuffled, by node and span of steps: the missing steps are filled in behind the shuffle, each
    reading being repeated up to the next one, with the times that its span's slice of the time dictionary has for them.
    With times too many to broadcast, readings are placed by span and slot of nodes, and every slot gets the slice.

    ``times`` and ``ids`` (see ``time_index`` and ``node_ids``) default to the times and sensors of ``df``. Of
    several rows for a cell, the one with the highest ``tiebreak`` wins (the highest values without
    one). ``mask_missing`` leaves empty cells NULL instead.
    """
    if times is None:
        times = time_index(df, time=time)
    if ids is None:
        ids = dense_index(df.select(sensor).distinct(), [sensor], "node_id")
    if tiebreak is None:
        highest = df.groupBy(time, sensor).agg(F.max(F.struct(*cols)).alias("cell"))
        cells = highest.select(time, sensor, "cell.*")
    else:
        cells = df.groupBy(time, sensor).agg(*[F.max_by(c, tiebreak).alias(c) for c in cols])
    n_times = times.count()
    small = fits_broadcast(times, broadcast_rows)
    by_time = F.broadcast(times) if small else times
    by_sensor = F.broadcast(ids) if fits_broadcast(ids, broadcast_rows) else ids
    span, width = F.expr(f"time_index div {steps_per_task}"), F.lit(steps_per_task)
    known = cells.join(by_time, time).join(by_sensor, sensor).select(sensor, "node_id", "time_index", *cols)
    # A row of its own opens every span of every node; each row then reaches to the next one of its span.
    spans = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, (n_times - 1) // steps_per_task)).cast("long")))
    opening = ids.select(sensor, "node_id", spans.alias("__span")).where(F.lit(n_times > 0))
    rows = known.withColumn("__span", span).unionByName(opening, allowMissingColumns=True)
    keys = ["__span"]
    if not small:
        # Rows are placed by span and slot of nodes, so that they meet the times of their span without another shuffle.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slots = max(1, -(-tasks * steps_per_task // max(n_times, 1)))
        rows = rows.withColumn("__slot", F.pmod(F.xxhash64("node_id"), F.lit(slots)).cast("int"))
        slices = _time_slices(times, time, steps_per_task)
        slices = slices.withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        keys = ["__span", "__slot"]
        rows = rows.repartition(*keys)
    window = Window.partitionBy("node_id", *keys).orderBy(F.col("time_index").asc_nulls_first())
    end = F.least((F.col("__span") + 1) * width, F.lit(n_times)).cast("long")
    first = F.coalesce("time_index", F.col("__span") * width)
    rows = rows.withColumns({"__first": first, "__last": F.coalesce(F.lead("time_index").over(window), end) - 1})
    if small:
        steps = F.when(F.col("__first") <= F.col("__last"), F.sequence("__first", "__last"))
        filled = rows.withColumn("__step", F.explode(steps)).join(by_time.select(F.col("time_index").alias("__step"), F.col(time).alias("__time")), "__step")
    else:
        place = (F.col("__first") - F.col("__span") * width + 1).cast("int")
        part = F.slice("__times", place, (F.col("__last") - F.col("__first") + 1).cast("int"))
        rows = rows.where(F.col("__first") <= F.col("__last")).join(slices, keys)
        filled = rows.select("*", F.posexplode(part).alias("__ahead", "__time"))
        filled = filled.withColumn("__step", F.col("__first") + F.col("__ahead"))
    read = F.col("__step").eqNullSafe(F.col("time_index"))
    panel = filled.select(
        F.col("__time").alias(time), sensor, F.col("__step").alias("time_index"), "node_id", *[F.when(read, F.col(c)).alias(c) for c in cols]
    )
    return panel if mask_missing else fill_zero(panel, cols)


def _time_slices(times: DataFrame, time: str, steps: int) -> DataFrame:
    """Per span of ``steps`` steps its times in order."""
    ordered = F.sort_array(F.collect_list(F.struct("time_index", F.col(time).alias("t"))))
    spans = times.groupBy(F.expr(f"time_index div {steps}").alias("__span")).agg(ordered.alias("__ordered"))
    return stored(spans.select("__span", F.col("__ordered")["t"].alias("__times")), "time-slices")


def chrono_split(
    panel: DataFrame,
    fraction: float = 0.8,
    *,
    times: DataFrame | None = None,
    split_col: str = "split",
) -> DataFrame:
    """Marks the first ``int(fraction * times)`` times as ``train`` and the rest as ``validation``.

    Without ``times`` their number is read off the panel, which computes it once more.
    """
    if times is None:
        total = panel.agg(F.max("time_index") + 1).first()[0] or 0
    else:
        total = times.count()
    cut = int(total * fraction)
    return panel.withColumn(
        split_col, F.when(F.col("time_index") < cut, "train").otherwise("validation")
    )


def sequences(
    panel: DataFrame,
    length: int = 12,
    horizon: int = 12,
    split_col: str | None = None,
    *,
    cols: Sequence[str] = ("speed",),
    target: str | None = None,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    steps_per_task: int = STEPS_PER_TASK,
) -> DataFrame:
    """Windows of ``length`` consecutive steps with the target ``horizon`` steps after the first.

    ``panel`` is dense; the target is ``pick_target(panel)`` unless given. Long panels are cut into spans of ``steps_per_task`` steps; the first steps of a
    span are also read by the span before it, so no window is lost at a cut.
    """
    target = target or pick_target(panel)
    reach = max(length - 1, horizon)
    span_steps = max(steps_per_task, reach)
    span = F.expr(f"time_index div {span_steps}")
    first_steps = F.col("time_index") % span_steps < reach
    keys = ["node_id", sensor] + ([split_col] if split_col else [])
    spread = panel.select(time, "time_index", *keys, *dict.fromkeys([*cols, target])).withColumn(
        "span", F.explode(F.when(first_steps, F.array(span, span - 1)).otherwise(F.array(span)))
    )
    types = {f.name: f.dataType for f in spread.schema}
    kept = [*keys, time, "time_index"]
    schema = T.StructType(
        [T.StructField(c, types[c]) for c in kept]
        + [T.StructField(f"{c}_sequence", T.ArrayType(types[c])) for c in cols]
        + [T.StructField("target", types[target])]
    )
    # In the order of the series a window is a run of rows, taken in whole batches: window functions build every array anew.
    ordered = spread.withColumn("__own", span == F.col("span")).repartition(*keys, "span").sortWithinPartitions(*keys, "span", "time_index")
    return ordered.mapInArrow(_windows(length, horizon, [*keys, "span"], kept, list(cols), target), schema)


def _windows(length: int, horizon: int, keys: list[str], kept: list[str], cols: list[str], target: str):
    """Per row its window and target, if both lie in its series and the row in its own span."""
    reach = max(length - 1, horizon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            held = rows.slice(max(0, rows.num_rows - reach))
            n = rows.num_rows - reach
            if n <= 0:
                continue
            whole = rows["__own"].slice(0, n)
            for key in keys:
                here, there = rows[key].slice(0, n), rows[key].slice(reach)
                equal = pc.fill_null(pc.equal(here, there), False)
                if here.null_count:
                    equal = pc.or_(equal, pc.and_(pc.is_null(here), pc.is_null(there)))
                whole = pc.and_(whole, equal)
            at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
            steps = pa.array((at[:, None] + np.arange(length)).reshape(-1))
            ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * length)
            found = [rows[c].take(pa.array(at)) for c in kept]
            found += [pa.ListArray.from_arrays(ends, rows[c].take(steps)) for c in cols]
            found.append(rows[target].take(pa.array(at + horizon)))
            yield pa.record_batch(found, names=[*kept, *[f"{c}_sequence" for c in cols], "target"])

    return run


def clean_features(
    df: DataFrame, drop: Sequence[str] = ("sensor_id", "timestamp", "traffic_trend_vector")
) -> DataFrame:
    """Everything but ``drop`` as a number; what is not a number becomes 0. Keeps the key columns."""
    parts = {}
    for field in df.schema.fields:
        if field.name in drop:
            continue
        if isinstance(field.dataType, T.NumericType):
            parts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.StringType):
            parts[field.name] = to_number(field.name)
        else:
            parts[field.name] = F.lit(None).cast("double")
    return fill_zero(df.withColumns(parts), list(parts))


def snapshots(
    panel: DataFrame,
    cols: Sequence[str],
    nodes_per_block: int = NODES_PER_BLOCK,
    *,
    time: str = "timestamp",
) -> DataFrame:
    """One row per time with, for every column, an array of its values in node order.

    Networks beyond ``nodes_per_block`` nodes continue in further rows of the same time (``block``), so
    that no row grows with the network.
    """
    block = F.expr(f"node_id div {nodes_per_block}").alias("block")
    ordered = F.sort_array(F.collect_list(F.struct("node_id", *cols)))
    grouped = panel.groupBy(time, "time_index", block).agg(ordered.alias("cells"))
    return grouped.select(
        time, "time_index", "block", *[F.col("cells")[c].alias(c) for c in cols]
    )
