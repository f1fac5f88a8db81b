"""Dense panels as tensors in shards of one fixed shape.

A shard holds a block of times by a block of nodes, time by time, one array per column, filled up with 0 at the ends of the
panel. Every cell is stored once; windows are made when shards are read, instead of being stored once per step they cover.
A manifest has shape, order and scaling, and the dictionaries of times and nodes stand beside it. The parts are replaced as
tables with versions are, the manifest last.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgraph.sources.versions import read_manifest, read_versioned, replace_table

TIMES_PER_SHARD, NODES_PER_SHARD = 288, 256
ORDER = "time, node"


def write_shards(
    panel: DataFrame, path: str, cols: Sequence[str], scaling: Mapping[str, tuple[float, float]] | None = None,
    times_per_shard: int = TIMES_PER_SHARD, nodes_per_shard: int = NODES_PER_SHARD, *, sensor: str = "sensor_id", time: str = "timestamp",
) -> None:
    """Writes a dense panel (see ``dense_panel``); a panel with missing or repeated cells raises.

    ``scaling`` has (shift, scale) per column: ``(x - shift) / scale`` is stored. NULL cells stay NULL. One shuffle of the
    panel, by shard; a shard has ``times_per_shard * nodes_per_shard`` cells.
    """
    spark, scaling = panel.sparkSession, dict(scaling or {})
    scaled = {c: (F.col(c).cast("double") - F.lit(float(scaling[c][0]))) / F.lit(float(scaling[c][1])) if c in scaling else F.col(c).cast("double") for c in cols}
    cells = panel.select(time, sensor, "time_index", "node_id", *[x.alias(c) for c, x in scaled.items()])
    size = cells.agg((F.max("time_index") + 1).alias("t"), (F.max("node_id") + 1).alias("n")).first()
    n_times, n_nodes = size["t"] or 0, size["n"] or 0
    block = lambda index, width, name: F.expr(f"`{index}` div {width}").alias(name)
    keys = block("time_index", times_per_shard, "time_block"), block("node_id", nodes_per_shard, "node_block")
    grouped = cells.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("time_index", "node_id", *cols))).alias("cells"))
    rows = F.least(F.lit(times_per_shard), F.lit(n_times) - F.col("time_block") * times_per_shard).cast("int")
    width = F.least(F.lit(nodes_per_shard), F.lit(n_nodes) - F.col("node_block") * nodes_per_shard).cast("int")
    fault = F.raise_error(F.concat(F.lit("missing or repeated cells in shard "), F.concat_ws(", ", "time_block", "node_block")))
    grouped = grouped.withColumns({"__rows": rows, "__width": width})
    whole = F.when(F.size("cells") == F.col("__rows") * F.col("__width"), F.col("cells")).otherwise(fault.cast(grouped.schema["cells"].dataType))
    filled = [_filled(F.col("__cells")[c], times_per_shard, nodes_per_shard).alias(c) for c in cols]
    shards = grouped.withColumn("__cells", whole).select("time_block", "node_block", *filled)
    replace_table(shards, f"{path}/shards")
    replace_table(cells.select("time_index", time).distinct(), f"{path}/times")
    replace_table(cells.select("node_id", sensor).distinct(), f"{path}/nodes")
    manifest = {
        "shape": [times_per_shard, nodes_per_shard], "panel": [n_times, n_nodes], "order": ORDER, "columns": list(cols),
        "scaling": {c: [float(x) for x in v] for c, v in scaling.items()}, "time": time, "sensor": sensor,
    }
    replace_table(spark.createDataFrame([(json.dumps(manifest),)], "manifest string"), f"{path}/manifest")


def _filled(values: Column, times: int, nodes: int) -> Column:
    """The cells of a shard at an end of the panel in the full shape."""
    line = lambda t: F.concat(F.slice(values, t * F.col("__width") + 1, F.col("__width")), F.array_repeat(F.lit(0.0), F.lit(nodes) - F.col("__width")))
    lines = F.flatten(F.transform(F.sequence(F.lit(0), F.col("__rows") - 1), line))
    return F.concat(lines, F.array_repeat(F.lit(0.0), (F.lit(times) - F.col("__rows")) * nodes))


def _table(spark: SparkSession, path: str) -> DataFrame:
    return read_versioned(spark, path, read_manifest(spark, path))


def shard_manifest(spark: SparkSession, path: str) -> dict:
    """``shape`` of a shard, size of the ``panel``, ``order``, ``columns`` and ``scaling``."""
    return json.loads(_table(spark, f"{path}/manifest").first()[0])


def read_shards(spark: SparkSession, path: str, unscale: bool = True) -> DataFrame:
    """The panel: one row per time and node, in the units of the source unless ``unscale`` is off."""
    facts = shard_manifest(spark, path)
    (times, nodes), (n_times, n_nodes), cols = facts["shape"], facts["panel"], facts["columns"]
    shards = _table(spark, f"{path}/shards")
    cells = shards.select("time_block", "node_block", F.posexplode(F.arrays_zip(*[F.col(c) for c in cols])))
    index = (F.col("time_block") * times + F.expr(f"pos div {nodes}")).cast("long"), (F.col("node_block") * nodes + F.col("pos") % nodes).cast("long")
    back = {c: F.col(f"col.{c}") for c in cols}
    if unscale:
        back |= {c: back[c] * F.lit(scale) + F.lit(shift) for c, (shift, scale) in facts["scaling"].items()}
    cells = cells.select(index[0].alias("time_index"), index[1].alias("node_id"), *[x.alias(c) for c, x in back.items()])
    cells = cells.where((F.col("time_index") < n_times) & (F.col("node_id") < n_nodes))
    return cells.join(_table(spark, f"{path}/times"), "time_index").join(_table(spark, f"{path}/nodes"), "node_id").select(
        facts["time"], facts["sensor"], "time_index", "node_id", *cols
    )


def shard_sequences(
    spark: SparkSession, path: str, length: int = 12, horizon: int = 12, *, cols: Sequence[str] = ("speed",), target: str = "target_speed"
) -> DataFrame:
    """Windows as ``sequences`` makes them, from shards: a shard's nodes are read as series over its times and the first
    ``max(length - 1, horizon)`` steps of the next shards, so a window is cut out of arrays and no cell is shuffled alone.
    """
    facts = shard_manifest(spark, path)
    (times, nodes), (n_times, n_nodes) = facts["shape"], facts["panel"]
    reach, used = max(length - 1, horizon), list(dict.fromkeys([*cols, target]))

    def of_node(c: str) -> Column:
        """The node's values over the times of its shard, in the units of the source."""
        shift, scale = facts["scaling"].get(c, (0.0, 1.0))
        return F.transform(F.sequence(F.lit(0), F.lit(times - 1)), lambda t: F.get(c, t * nodes + F.col("__node")) * F.lit(scale) + F.lit(shift))

    series = _table(spark, f"{path}/shards").select("time_block", "node_block", F.posexplode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("__at", "__node"), *used)
    series = series.where(F.col("node_block") * nodes + F.col("__node") < n_nodes)
    series = series.select("time_block", (F.col("node_block") * nodes + F.col("__node")).cast("long").alias("node_id"), *[of_node(c).alias(c) for c in used])
    ahead = -(-reach // times)
    parts = series.withColumn("__ahead", F.explode(F.sequence(F.lit(0), F.lit(ahead))))
    head = lambda c: F.when(F.col("__ahead") == 0, F.col(c)).otherwise(F.slice(c, 1, reach))
    parts = parts.select("node_id", (F.col("time_block") - F.col("__ahead")).alias("time_block"), "__ahead", *[head(c).alias(c) for c in used]).where("time_block >= 0")
    joined = parts.groupBy("node_id", "time_block").agg(F.sort_array(F.collect_list(F.struct("__ahead", *used))).alias("__parts"))
    start = F.col("time_block") * times
    last = F.least(F.lit(times - 1), F.lit(n_times - 1 - reach) - start).cast("int")  # the last window that is whole
    steps = joined.where(last >= 0).select("node_id", "time_block", *[F.flatten(F.col("__parts")[c]).alias(c) for c in used], F.explode(F.sequence(F.lit(0), last)).alias("__step"))
    found = steps.select(
        "node_id", (start + F.col("__step")).cast("long").alias("time_index"),
        *[F.slice(c, F.col("__step") + 1, length).alias(f"{c}_sequence") for c in cols], F.get(target, F.col("__step") + horizon).alias("target"),
    )
    return found.join(_table(spark, f"{path}/times"), "time_index").join(_table(spark, f"{path}/nodes"), "node_id").select(
        "node_id", facts["sensor"], facts["time"], "time_index", *[f"{c}_sequence" for c in cols], "target"
    )
