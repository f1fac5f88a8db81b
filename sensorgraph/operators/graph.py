"""Features of the weighted sensor network, PageRank and neighbour propagation.

Edges are collapsed to one row per (source, destination) before anything is summed per sensor, so a hub
with a large share of the edges is first combined per pair and per task. Joins of links with per-source
values either broadcast a side whose row count was checked, or shuffle with the links of a hub spread
over several slots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.config import BROADCAST_ROWS, LINKS_PER_SLOT
from sensorgraph.operators import tiles
from sensorgraph.operators.reshape import fill_defaults
from sensorgraph.operators.storage import fits_broadcast, stored, stored_by

# Output columns and what stands for a missing one.
END_DEFAULTS = {
    "out_degree": 0,
    "in_degree": 0,
    "degree": 0,
    "out_weight_degree": 0.0,
    "in_weight_degree": 0.0,
    "weighted_degree": 0.0,
    "neighbor_count": 0,
    "avg_neighbor_weight": 0.0,
}
GRAPH_DEFAULTS = END_DEFAULTS | {"pagerank": 0.0}


def vertices(edges: DataFrame, *, sensor: str = "sensor_id") -> DataFrame:
    """Distinct sensors of both edge ends; a missing end is no sensor."""
    sources = edges.select(F.col("source_sensor").alias(sensor))
    return sources.union(edges.select("destination_sensor")).where(F.col(sensor).isNotNull()).distinct()


def restrict_to_graph(df: DataFrame, edges: DataFrame, *, sensor: str = "sensor_id") -> DataFrame:
    """Rows whose sensor is an end of some edge."""
    return df.join(stored(vertices(edges, sensor=sensor), "vertices"), sensor, "left_semi")


def collapse_edges(edges: DataFrame) -> DataFrame:
    """One row per (source, destination): edge rows, summed weight and number of weights.

    Edges without a source or a destination are no edges and are dropped here, for all features alike.
    """
    return edges.where(F.col("source_sensor").isNotNull() & F.col("destination_sensor").isNotNull()).groupBy("source_sensor", "destination_sensor").agg(
        F.count("*").alias("edge_rows"),
        F.sum(F.col("weight").cast("double")).alias("weight"),
        F.count("weight").alias("weighted_rows"),
    )


def edge_end_features(edges: DataFrame, *, sensor: str = "sensor_id") -> DataFrame:
    """Degrees, weighted degrees and out-neighbours of every sensor."""
    return _end_features(collapse_edges(edges), sensor)


def _end_features(pairs: DataFrame, sensor: str) -> DataFrame:
    ends = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("source_sensor").alias(sensor),
                    F.col("edge_rows").alias("out_rows"),
                    F.col("weight").alias("out_weight"),
                    F.col("weighted_rows").alias("out_weights"),
                    F.col("destination_sensor").isNotNull().cast("long").alias("neighbor"),
                    F.lit(None).cast("long").alias("in_rows"),
                    F.lit(None).cast("double").alias("in_weight"),
                ),
                F.struct(
                    F.col("destination_sensor").alias(sensor),
                    F.lit(None).cast("long").alias("out_rows"),
                    F.lit(None).cast("double").alias("out_weight"),
                    F.lit(None).cast("long").alias("out_weights"),
                    F.lit(None).cast("long").alias("neighbor"),
                    F.col("edge_rows").alias("in_rows"),
                    F.col("weight").alias("in_weight"),
                ),
            )
        )
    )
    totals = ends.groupBy(sensor).agg(
        F.sum("out_rows").alias("out_degree"),
        F.sum("in_rows").alias("in_degree"),
        F.sum("out_weight").alias("out_weight_degree"),
        F.sum("in_weight").alias("in_weight_degree"),
        F.sum("neighbor").alias("neighbor_count"),
        F.try_divide(F.sum("out_weight"), F.sum("out_weights")).alias("avg_neighbor_weight"),
    )
    return fill_defaults(totals, END_DEFAULTS).select(
        sensor,
        "out_degree",
        "in_degree",
        (F.col("out_degree") + F.col("in_degree")).alias("degree"),
        "out_weight_degree",
        "in_weight_degree",
        (F.col("out_weight_degree") + F.col("in_weight_degree")).alias("weighted_degree"),
        "neighbor_count",
        "avg_neighbor_weight",
    )


def transitions(edges: DataFrame) -> DataFrame:
    """``(source_sensor, destination_sensor, transition)``, one row per pair.

    The transition is the pair's share of all weight leaving its source; a source without weight has
    none to pass on, so its transitions are 0.
    """
    return _transitions(stored(collapse_edges(edges), "edge-pairs"))


def _transitions(pairs: DataFrame) -> DataFrame:
    # Written, so that size decides on a broadcast and a hub's links can be split where the join is shuffled: an
    # aggregation right below a join cannot.
    totals = stored(pairs.groupBy("source_sensor").agg(F.sum("weight").alias("total_weight")), "source-weights")
    share = F.try_divide("weight", "total_weight")
    return pairs.join(totals, "source_sensor").select(
        "source_sensor", "destination_sensor", F.coalesce(share, F.lit(0.0)).alias("transition")
    )


def pagerank(
    edges: DataFrame,
    iterations: int = 10,
    reset: float = 0.15,
    store_every: int = 5,
    *,
    sensor: str = "sensor_id",
    broadcast_rows: int = BROADCAST_ROWS,
    links_per_slot: int = LINKS_PER_SLOT,
) -> DataFrame:
    """Weighted, un-normalised PageRank: start at 1, a fixed number of iterations, no mass is returned
    from sensors without out-weight."""
    pairs = stored(collapse_edges(edges), "edge-pairs")
    return _pagerank(pairs, iterations, reset, store_every, sensor, broadcast_rows, links_per_slot)


def _pagerank(pairs, iterations, reset, store_every, sensor, broadcast_rows, links_per_slot):
    # A zero link from every sensor to itself keeps sensors without incoming edges in each sum,
    # so an iteration is one join and one aggregation.
    anchors = vertices(pairs, sensor="v").select("v", F.col("v").alias("u"), F.lit(0.0).alias("p"))
    links = stored(
        _transitions(pairs)
        .toDF("source_sensor", "destination_sensor", "transition")
        .union(anchors),
        "rank-links",
    )
    inflow = F.lit(reset) + F.lit(1 - reset) * F.coalesce(F.sum("passed"), F.lit(0.0))
    if iterations == 0:
        return vertices(pairs, sensor=sensor).withColumn("pagerank", F.lit(1.0))
    # Every sensor has a link, so few links mean few ranks; only otherwise are the sensors counted.
    small = fits_broadcast(links, broadcast_rows) or fits_broadcast(
        links.select("source_sensor", "transition").groupBy("source_sensor").agg(F.max("transition")), broadcast_rows
    )
    spread = None if small else SpreadLinks(links, links_per_slot)
    ranks = None
    for i in range(iterations):
        if ranks is None:  # all ranks are 1
            passed = links.withColumn("passed", F.col("transition"))
        else:
            if i % store_every == 0:
                ranks = stored(ranks, "ranks")
            joined = (
                links.join(F.broadcast(ranks), F.col("source_sensor") == F.col(sensor))
                if spread is None
                else spread.join(ranks, sensor)
            )
            passed = joined.withColumn("passed", F.col("pagerank") * F.col("transition"))
        ranks = passed.groupBy(F.col("destination_sensor").alias(sensor)).agg(
            inflow.alias("pagerank")
        )
    return ranks


class SpreadLinks:
    """Links partitioned once by (source, slot), where the links of a hub fill several slots.

    Values that are joined by source are copied once per slot of their source, so no task holds more
    than about ``links_per_slot`` links of one sensor.
    """

    def __init__(self, links: DataFrame, links_per_slot: int = LINKS_PER_SLOT):
        self.hubs = stored(
            links.groupBy("source_sensor")
            .count()
            .where(F.col("count") > links_per_slot)
            .select("source_sensor", F.ceil(F.col("count") / links_per_slot).cast("int").alias("slots")),
            "hubs",
        )
        slots = F.coalesce("slots", F.lit(1))
        self.links = stored_by(
            links.join(self.hubs, "source_sensor", "left")
            .withColumn("slot", F.pmod(F.xxhash64("destination_sensor"), slots).cast("int"))
            .drop("slots"),
            "spread-links",
            ["source_sensor", "slot"],
        )

    def join(self, values: DataFrame, sensor: str) -> DataFrame:
        """Links with the values of their source."""
        hubs = self.hubs.withColumnRenamed("source_sensor", "hub")
        copies = (
            values.join(hubs, F.col(sensor) == F.col("hub"), "left")
            .withColumn("value_slot", F.explode(F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1)))
            .drop("hub", "slots")
        )
        same = (F.col("source_sensor") == F.col(sensor)) & (F.col("slot") == F.col("value_slot"))
        return self.links.join(copies, same).drop("slot", "value_slot")


def normalized_links(edges: DataFrame) -> DataFrame:
    """Symmetrically normalised links ``w / sqrt(d_source * d_destination)``.

    Every sensor without a self-loop gets one of weight 1; ``d`` is the weight arriving at a sensor, its
    self-loop included. Repeated edges add up.
    """
    weight = F.col("weight").cast("double")
    none = F.lit(None).cast("double")
    edges = edges.where(F.col("source_sensor").isNotNull() & F.col("destination_sensor").isNotNull())
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("source_sensor").alias("src"), F.col("destination_sensor").alias("dst"), weight.alias("w")),
                F.struct(F.col("source_sensor").alias("src"), F.col("source_sensor").alias("dst"), none.alias("w")),
                F.struct(F.col("destination_sensor").alias("src"), F.col("destination_sensor").alias("dst"), none.alias("w")),
            )
        )
    )
    missing = F.when(F.col("src") == F.col("dst"), 1.0).otherwise(0.0)
    links = stored(ends.groupBy("src", "dst").agg(F.sum("w").alias("w")).select(
        "src", "dst", F.coalesce("w", missing).alias("w")
    ), "propagation-links")
    arriving = stored(links.groupBy("dst").agg(F.sum("w").alias("d")), "propagation-weights")
    root = F.sqrt(F.col("d_src")) * F.sqrt(F.col("d_dst"))
    usable = (F.col("d_src") > 0) & (F.col("d_dst") > 0)
    return (
        links.join(arriving.select(F.col("dst").alias("src"), F.col("d").alias("d_src")), "src")
        .join(arriving.withColumnRenamed("d", "d_dst"), "dst")
        .select(
            F.col("src").alias("source_sensor"),
            F.col("dst").alias("destination_sensor"),
            F.when(usable, F.col("w") / root).otherwise(0.0).alias("coefficient"),
        )
    )


def propagate(
    panel: DataFrame,
    edges: DataFrame,
    cols: Sequence[str],
    hops: int = 1,
    *,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    broadcast_rows: int = BROADCAST_ROWS,
    links_per_slot: int = LINKS_PER_SLOT,
) -> DataFrame:
    """``(time, sensor, cols)`` where each column is the normalised sum over in-neighbours at that time.

    ``panel`` has at most one row per sensor and time (see ``dense_panel``). Sensors outside the network are left out
    before anything is shuffled. With links that are checked to be few, they are broadcast; over several hops rows are then
    placed by time once, if there are times enough. Otherwise readings and links are multiplied in blocks (see ``tiles``):
    readings are shuffled once into tiles and no row per link and time is made; links of a hub fill several strips.
    """
    links = stored(normalized_links(edges), "propagation-coefficients")
    known = stored(links.select(F.col("source_sensor").alias(sensor)).distinct(), "propagation-sensors")
    rows = panel.select(time, sensor, *cols).join(known, sensor, "left_semi")
    if not fits_broadcast(links, broadcast_rows):
        return _propagate_tiles(rows, links, known, cols, hops, sensor, time, links_per_slot)
    totals = [F.sum(F.col(c) * F.col("coefficient")).alias(c) for c in cols]
    if hops > 1:
        # Rows of a time stay together for all hops, unless there are too few times to fill the tasks.
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if rows.select(time).distinct().limit(4 * tasks).count() == 4 * tasks:
            rows = rows.repartition(time)
    for _ in range(hops):
        joined = rows.join(F.broadcast(links), F.col(sensor) == F.col("source_sensor"))
        rows = joined.groupBy(time, F.col("destination_sensor").alias(sensor)).agg(*totals)
    return rows


def _propagate_tiles(rows, links, known, cols, hops, sensor, time, links_per_slot):
    types = dict(rows.dtypes)
    times = stored(rows.select(time).distinct(), "propagation-times")
    n_sensors, n_times, n_links = known.count(), times.count(), links.count()
    # From the second hop on nearly every sensor has a value at every time.
    n_readings = rows.count() if hops == 1 else n_sensors * n_times
    to = tiles.layout(n_sensors, n_times, n_readings, n_links, len(cols))
    sensors, times = tiles.placed_sensors(known, sensor, to), tiles.placed_times(times, time, to)
    strips = tiles.strips(links, sensors, sensor, links_per_slot)
    for _ in range(hops):
        own = stored(tiles.tiles(rows, cols, sensors, times, sensor, time), "propagation-tiles")
        rows = tiles.multiply(tiles.cells(own, strips, sensors, times, sensor, time, to), cols, sensor, time, types, to)
    return rows
