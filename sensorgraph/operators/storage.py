"""Intermediate tables in the folder that all executors share.

A written table cuts the lineage of an expensive step, survives the loss of executors, and gives
Catalyst the true size of a small side, so that a broadcast is planned by measured size only. Tables stay until
``release`` or the end of a ``temporary`` block, because results may still read them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes per row that the row limits of a broadcast by hand stand for.
BROADCAST_ROW_BYTES = 64
#: Setting that allows a folder of the plain file scheme on a cluster, where it must be a shared mount.
SHARED_MOUNT = "spark.sensorgraph.sharedMount"
_made: list[tuple[SparkSession, str, str | None]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    on_cluster = not context.master.startswith("local")
    if folder is None:
        if on_cluster:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sensorgraph-"))
        folder = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    if on_cluster and folder.startswith("file:") and spark.conf.get(SHARED_MOUNT, "false") != "true":
        raise ValueError(f"{folder} is local to each machine; set {SHARED_MOUNT}=true if it is a shared mount")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; no two calls return the same one."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path, None))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once and returns the scan of the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Like ``stored``, bucketed and sorted by ``keys``: repeated joins on them do not shuffle it again.

    The buckets are known through a catalog entry, which stays as long as the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = "sensorgraph_" + path.rsplit("/", 1)[1].replace("-", "_")
    _made[-1] = (spark, path, table)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)


def release(since: int = 0) -> None:
    """Deletes what was stored, all or from the given position on; results that read it must be written before."""
    while len(_made) > since:
        spark, path, table = _made.pop()
        if table:
            spark.sql(f"drop table if exists {table}")
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder by Spark's own file systems; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def temporary() -> Iterator[None]:
    """Releases at its end what was stored within."""
    since = len(_made)
    try:
        yield
    finally:
        release(since)


def fits_broadcast(df: DataFrame, most_rows: int) -> bool:
    """Whether rows and bytes (texts as they are, other values 8 bytes each) stay within the limit."""
    size = F.lit(0)
    for field in df.schema:
        text = isinstance(field.dataType, T.StringType | T.BinaryType)
        size = size + (F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) if text else F.lit(8))
    rows, total = df.agg(F.count("*"), F.sum(size)).first()
    return rows <= most_rows and (total or 0) <= most_rows * BROADCAST_ROW_BYTES
