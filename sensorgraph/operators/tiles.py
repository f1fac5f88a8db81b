"""Propagation as a product of a sparse matrix of links and a panel, in blocks of the result.

Sensors and times are divided into blocks by their hashes. A cell is a block of destinations at a block of times, small
enough for one table in a task. Every cell gets the readings of its times as tiles (one per block of sources) and the links
to its destinations as strips, in the order of the block of sources, and adds each strip times its tile to the table. So
neither rows of links times readings nor partial sums are ever shuffled: what moves are the readings once per block of
destinations and the links once per block of times, and ``layout`` weighs the two against each other. Built-in functions
have no such product, hence NumPy in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgraph.operators.storage import stored

#: Numbers of the table of a cell at most, and cells that are wanted at least where they stay larger than the lowest size.
MOST_IN_CELL, LEAST_IN_CELL, CELLS = 1 << 22, 1 << 16, 64
#: Readings of a tile, its sources and the times of a block (a place in a tile has 16 bits for the time).
MOST_IN_TILE, SENSORS_PER_BLOCK, TIMES_PER_BLOCK = 1 << 17, 1024, 1 << 14
#: Links of a strip: the least that a limit is rounded to, and how many of these it has at most.
LINKS_PER_STRIP, MOST_STRIPS = 1024, 32
#: Bytes that move per reading and per link.
READING_BYTES, LINK_BYTES = 12, 16
#: Joined rows of an Arrow batch: a tile and a strip hold up to some 2 MB.
ROWS_PER_BATCH = 16
#: Partitions of the shuffle to cells at most.
MOST_PARTITIONS = 10_000
#: Products that are made at a time.
PRODUCTS = 1 << 18
#: Rows of a batch that a cell returns, about.
ROWS_OUT = 1 << 17
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
DICTIONARY, TILE, STRIP = 0, 1, 2


class Layout(NamedTuple):
    """Blocks of sources, of destinations and of times."""

    sources: int
    destinations: int
    times: int


def layout(n_sensors: int, n_times: int, n_readings: int, n_links: int, width: int) -> Layout:
    """Cells within their limit for which the fewest bytes move: readings times blocks of destinations and links times
    blocks of times."""
    numbers = n_sensors * n_times * width
    most = max(1, min(MOST_IN_CELL, max(LEAST_IN_CELL, -(-numbers // CELLS))) // width)
    readings, links = max(1, n_readings * READING_BYTES * width), max(1, n_links * LINK_BYTES)
    # With t times in a block, a cell has most / t destinations: readings * n_sensors * t / most + links * n_times / t.
    t = (links * n_times * most / (readings * max(1, n_sensors))) ** 0.5
    t = int(min(max(t, most / max(1, n_sensors), 1), most, max(1, n_times), TIMES_PER_BLOCK))
    per_block = min(SENSORS_PER_BLOCK, max(1, MOST_IN_TILE // (t * width)))
    return Layout(1 + n_sensors // per_block, max(1, -(-n_sensors * t // most)), max(1, -(-n_times // t)))


def block_of(column: str, blocks: int, seed: int = 0):
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(blocks)).cast("int")


def _place(block: str, order: str):
    return (F.row_number().over(Window.partitionBy(block).orderBy(order)) - 1).cast("int")


def placed_sensors(known: DataFrame, sensor: str, to: Layout) -> DataFrame:
    """Per sensor its block and place as a source and as a destination; stored."""
    blocks = known.withColumns({"__block": block_of(sensor, to.sources), "__to": block_of(sensor, to.destinations, 1)})
    return stored(blocks.withColumns({"__place": _place("__block", sensor), "__to_place": _place("__to", sensor)}), "placed-sensors")


def placed_times(times: DataFrame, time: str, to: Layout) -> DataFrame:
    """Per time its block and place; stored."""
    return stored(times.withColumn("__times", block_of(time, to.times)).withColumn("__time_place", _place("__times", time)), "placed-times")


def strips(links: DataFrame, sensors: DataFrame, sensor: str, links_per_slot: int) -> DataFrame:
    """Links by block of their source and of their destination, in the order of their destination; stored.

    Many links between two blocks fill several strips by the destination's hash, each of ``links_per_slot`` links rounded
    to whole ``LINKS_PER_STRIP``.
    """
    per_strip = LINKS_PER_STRIP * min(MOST_STRIPS, max(1, links_per_slot // LINKS_PER_STRIP))
    sources = sensors.select(F.col(sensor).alias("source_sensor"), "__block", "__place")
    destinations = sensors.select(F.col(sensor).alias("destination_sensor"), "__to", "__to_place")
    placed = links.join(sources, "source_sensor").join(destinations, "destination_sensor")
    placed = stored(placed.select("__block", "__to", "__place", "__to_place", "coefficient"), "placed-links")
    sizes = placed.groupBy(F.col("__block").alias("__b"), F.col("__to").alias("__t")).agg(F.ceil(F.count("*") / per_strip).cast("int").alias("__many"))
    many = stored(sizes.where("__many > 1"), "block-sizes")
    placed = placed.join(many, (F.col("__block") == F.col("__b")) & (F.col("__to") == F.col("__t")), "left")
    strip = F.pmod(F.xxhash64("__to_place"), F.coalesce("__many", F.lit(1))).alias("__strip")
    link = F.struct(F.col("__to_place").alias("to"), F.col("__place").alias("from"), F.col("coefficient").alias("by"))
    grouped = placed.groupBy("__block", "__to", strip).agg(F.sort_array(F.collect_list(link)).alias("links"))
    return stored(grouped.select("__block", "__to", *[F.col("links")[c].alias(f"__{c}s") for c in ("to", "from", "by")]).toDF("__block", "__to", "tos", "froms", "bys"), "strips")


def tiles(rows: DataFrame, cols: Sequence[str], sensors: DataFrame, times: DataFrame, sensor: str, time: str) -> DataFrame:
    """Readings by block of sensors and block of times; each stands in one tile. Sensors outside the network have none."""
    named = times.withColumnRenamed(time, "__time")
    placed = rows.join(sensors.select(sensor, "__block", "__place"), sensor).join(named, F.col(time).eqNullSafe(F.col("__time")))
    at = (F.shiftleft("__place", 16) + F.col("__time_place")).alias("at")
    cell = F.struct(at, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    grouped = placed.groupBy("__block", "__times").agg(F.collect_list(cell).alias("cells"))
    return grouped.select("__block", "__times", F.col("cells")["at"].alias("at"), *[F.col("cells")[f"v{i}"].alias(f"v{i}") for i in range(len(cols))])


def cells(own: DataFrame, links: DataFrame, sensors: DataFrame, times: DataFrame, sensor: str, time: str, to: Layout) -> DataFrame:
    """All that a cell needs, one row per tile, strip and dictionary: tiles for each block of destinations, strips for each
    block of times."""
    listed = lambda df, block, place, name, out: df.groupBy(block).agg(
        F.sort_array(F.collect_list(F.struct(F.col(place), F.col(name).alias("name"))))["name"].alias(out)
    )
    names = listed(sensors, "__to", "__to_place", sensor, "sensors").crossJoin(listed(times, "__times", "__time_place", time, "times"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    parts = [
        names.withColumns({"__kind": F.lit(DICTIONARY), "__block": F.lit(-1)}),
        own.withColumns({"__kind": F.lit(TILE), "__to": every(to.destinations)}),
        links.withColumns({"__kind": F.lit(STRIP), "__times": every(to.times)}),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.withColumn("__cell", F.col("__to") * F.lit(to.times) + F.col("__times"))


class _Cell:
    """The sums per destination and time of a cell, and which of them any reading went into."""

    def __init__(self, sensors: pa.Array, times: pa.Array, width: int):
        self.sensors, self.times, self.width = sensors, times, width
        self.sums = np.zeros((width, len(sensors), len(times)))
        # Presence of a reading, then of each value, in bits along the times.
        self.there = np.zeros((1 + width, len(sensors), -(-len(times) // 8)), np.uint8)
        self.block = None

    def tile(self, block: int, at: pa.Array, values: list[pa.Array]) -> None:
        place, time = np.divmod(at.to_numpy(), 1 << 16)
        shape = (1 + int(place.max()), len(self.times))
        self.block, self.values = block, np.zeros((self.width, *shape))
        there = np.zeros((1 + self.width, *shape), bool)
        there[0, place, time] = True
        for i, found in enumerate(values):
            there[1 + i, place, time] = found.is_valid().to_numpy(zero_copy_only=False)
            self.values[i, place, time] = pc.fill_null(found, 0.0).to_numpy(zero_copy_only=False)
        self.read, self.present = np.packbits(there, axis=2), there[0].any(axis=1)

    def strip(self, block: int, to: np.ndarray, source: np.ndarray, by: np.ndarray) -> None:
        if block != self.block:  # no source of the block has a reading
            return
        known = source < len(self.present)
        known[known] = self.present[source[known]]
        to, source, by = to[known], source[known], by[known]
        step = max(1, PRODUCTS // len(self.times))
        for a in range(0, len(to), step):
            t, s, b = to[a : a + step], source[a : a + step], by[a : a + step, None]
            starts = np.flatnonzero(np.diff(t, prepend=-1))  # links are in the order of their destination
            rows = t[starts]
            for sums, values in zip(self.sums, self.values, strict=True):
                sums[rows] += np.add.reduceat(b * values[s], starts)
            for there, read in zip(self.there, self.read, strict=True):
                there[rows] |= np.bitwise_or.reduceat(read[s], starts)

    def result(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        """A row per destination and time that any source has a reading for."""
        step = max(1, ROWS_OUT // len(self.times))
        for a in range(0, len(self.sensors), step):
            there = np.unpackbits(self.there[:, a : a + step], axis=2, count=len(self.times)).astype(bool)
            row, column = np.nonzero(there[0])
            sums = [pa.array(s[a : a + step][row, column], mask=~t[row, column]) for s, t in zip(self.sums, there[1:], strict=True)]
            if len(row):
                yield pa.record_batch([self.times.take(pa.array(column)), self.sensors.take(pa.array(a + row)), *sums], names=names)


def _multiplied(width: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, cell = None, None
        for batch in batches:
            of = lambda c: batch[c][k].values  # noqa: B023, E731
            for k, (number, kind, block) in enumerate(zip(*[batch[c].to_pylist() for c in ("__cell", "__kind", "__block")], strict=True)):
                if number != current:
                    if cell is not None:
                        yield from cell.result(names)
                    # Its dictionary comes first; a block that no sensor or no time fell into has none and no result.
                    current, cell = number, _Cell(of("sensors"), of("times"), width) if kind == DICTIONARY else None
                elif cell is not None and kind == TILE:
                    cell.tile(block, of("at"), [of(f"v{i}") for i in range(width)])
                elif cell is not None:
                    cell.strip(block, *[of(c).to_numpy() for c in ("tos", "froms", "bys")])
        if cell is not None:
            yield from cell.result(names)

    return run


def multiply(rows: DataFrame, cols: Sequence[str], sensor: str, time: str, types: dict[str, str], to: Layout) -> DataFrame:
    """``(time, sensor, cols)`` from the rows of ``cells``; stored. A cell is in one task, and its rows are in order."""
    spark = rows.sparkSession
    schema = ", ".join(f"`{c}` {t}" for c, t in ((time, types[time]), (sensor, types[sensor]), *((c, "double") for c in cols)))
    tasks = min(MOST_PARTITIONS, to.destinations * to.times)
    placed = rows.repartitionById(tasks, F.pmod("__cell", F.lit(tasks))).sortWithinPartitions("__cell", "__block", "__kind")
    products = placed.mapInArrow(_multiplied(len(cols), [time, sensor, *cols]), schema)
    usual = spark.conf.get(BATCH_SETTING)
    try:  # read when the plan runs
        spark.conf.set(BATCH_SETTING, str(ROWS_PER_BATCH))
        return stored(products, "propagated")
    finally:
        spark.conf.set(BATCH_SETTING, usual)
