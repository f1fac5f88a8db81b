"""Tables in plain folders that are replaced, or merged by date, without a moment at which they are gone.

A table's folder holds versions, each written once under a name of its own, and a manifest that names the folders which are
the table now. A write adds a version and swaps the manifest by one rename at its end; a write that fails before that leaves
the table as it was. Folders that a new manifest no longer names stay until the write after it, for readers under way.
There is one writer at a time; a second one that started from the same manifest raises instead of undoing the first.
"""

from __future__ import annotations

import json
import time as clock
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgraph.operators.storage import delete

MANIFEST, VERSIONS = "_manifest", "_versions"
#: Column of the date that partitions a merged table; it is no column of the table.
DAY = "__day"
#: Rows of one date that a merging task holds.
ROWS_PER_SLOT = 5_000_000


class Conflict(RuntimeError):
    """Another writer swapped the manifest meanwhile."""


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """What the table is now: ``format``, ``id`` and ``parts``, from a date (or "" for all rows) to a folder; None for a
    folder without versions."""
    place, files = _place(spark, f"{path}/{MANIFEST}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _swap(spark: SparkSession, path: str, manifest: dict, before: dict | None) -> None:
    new = f"{path}/{MANIFEST}.{uuid.uuid4().hex}"
    place, files = _place(spark, new)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    now = read_manifest(spark, path)
    if (now or {}).get("id") != (before or {}).get("id"):
        delete(spark, new)
        raise Conflict(f"{path} was changed by another writer")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    option = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(place, _place(spark, f"{path}/{MANIFEST}")[0], options)


def _publish(spark: SparkSession, path: str, fmt: str, parts: dict[str, str], before: dict | None) -> None:
    """Makes ``parts`` the table, then deletes what the manifest before the last one still named."""
    old = set((before or {}).get("parts", {}).values())
    retired = sorted(old - set(parts.values()))
    _swap(spark, path, {"id": uuid.uuid4().hex, "format": fmt, "parts": parts, "retired": retired}, before)
    for folder in (before or {}).get("retired", []):
        delete(spark, f"{path}/{folder}")
    if before is None:  # files of a plain table that stood here before
        place, files = _place(spark, path)
        for status in files.listStatus(place):
            if not status.getPath().getName().startswith(("_manifest", "_versions")):
                files.delete(status.getPath(), True)


def _new_version() -> str:
    return f"{VERSIONS}/{int(clock.time() * 1000):013d}-{uuid.uuid4().hex[:12]}"


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """``df`` becomes the table at ``path``, with its own columns; if the write fails, the old table stays readable.

    ``df`` may read the table that it replaces.
    """
    spark, folder = df.sparkSession, _new_version()
    before = read_manifest(spark, path)
    try:
        df.write.format(fmt).options(**options).save(f"{path}/{folder}")
        _publish(spark, path, fmt, {"": folder}, before)
    except BaseException:
        delete(spark, f"{path}/{folder}")
        raise


def read_versioned(spark: SparkSession, path: str, manifest: dict, days: Sequence[str] | None = None) -> DataFrame | None:
    """The rows of all dates or of the given ones; None if there are none of those. Columns that a version lacks are NULL."""
    folders = sorted({f for day, f in manifest["parts"].items() if days is None or day in days})
    versions: dict[str, list[str]] = {}
    for folder in folders:
        versions.setdefault("/".join(folder.split("/")[:2]), []).append(folder)
    frames = [spark.read.format(manifest["format"]).load([f"{path}/{f}" for f in own]) for own in versions.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def _day(time: str) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("none"))


def merge_readings(
    new: DataFrame, path: str, keys: Sequence[str] = ("sensor_id", "timestamp"), time: str = "timestamp",
    order: str | None = None, fmt: str = "parquet", rows_per_slot: int = ROWS_PER_SLOT, most_versions: int = 50,
) -> list[str]:
    """Merges rows into the table at ``path`` and returns the dates that were written anew.

    A row takes the place of the table's row of the same keys; of several new ones the highest ``order`` wins (without it,
    the highest values). Only dates that ``new`` has rows for are read and written; a row without a time belongs to a date
    of its own. One shuffle by date and slot of the keys; a date with many rows has several slots. The driver sees one row
    per date. A table whose dates lie in more than ``most_versions`` versions is written as one version again. Repeating a
    merge changes nothing, so a job that failed is run again.
    """
    spark = new.sparkSession
    before = read_manifest(spark, path)
    if before is not None and "" in before["parts"]:
        raise ValueError(f"{path} is not divided by date")
    new = new.withColumn(DAY, _day(time))
    counts = {r[DAY]: r["count"] for r in new.groupBy(DAY).count().collect()}
    if not counts:
        return []
    parts = dict((before or {}).get("parts", {}))
    compact = len({f.split("/")[1] for f in parts.values()}) >= most_versions
    old = read_versioned(spark, path, before, None if compact else list(counts)) if before else None
    others = [c for c in new.columns if c not in (*keys, DAY)]
    ranked = new.withColumns({"__new": F.lit(1), "__order": F.col(order) if order else F.struct(*others)})
    if old is not None:
        old = old.withColumns({DAY: _day(time), "__new": F.lit(0)})
        ranked = ranked.unionByName(old, allowMissingColumns=True)
        others = [c for c in ranked.columns if c not in (*keys, DAY, "__new", "__order")]
    most = max(counts.values())
    slot = F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-most // rows_per_slot)))).cast("int")
    placed = ranked.withColumn("__slot", slot).repartition(DAY, "__slot")
    rank = F.struct("__new", "__order")
    merged = placed.groupBy(DAY, "__slot", *keys).agg(F.max_by(F.struct(*others), rank).alias("__row"))
    merged = merged.select(DAY, *keys, "__row.*").select(DAY, *[c for c in ranked.columns if c in (*keys, *others)])
    folder = _new_version()
    try:
        merged.write.format(fmt).partitionBy(DAY).save(f"{path}/{folder}")
        written = set(parts) | set(counts) if compact else set(counts)
        parts |= {day: f"{folder}/{DAY}={day}" for day in written}
        _publish(spark, path, fmt, parts, before)
    except BaseException:
        delete(spark, f"{path}/{folder}")
        raise
    return sorted(counts)
