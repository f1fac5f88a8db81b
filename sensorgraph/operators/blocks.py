"""Rows of numbers in stored blocks, which NumPy reads many times over.

A row of the stored table is a block: some ten thousand rows in a few binary values. Where a column is the one before it
moved by a row, as in windows over a series, only the places that differ are written, so samples of overlapping windows take
little more than the series. Any other rows are kept whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T

from sensorgraph.operators.storage import scratch_path

#: Rows of a block, of which a task holds a few at a time, and bytes of a row group of blocks, which are read at once.
ROWS_PER_BLOCK, BLOCK_GROUP = 1 << 15, 16 << 20
#: Blocks of an Arrow batch, and tasks per core of a pass.
BLOCKS_PER_BATCH, TASKS_PER_CORE = 4, 2
#: A column is written by its differences if these are less than this share of its rows.
FEW = 0.25
MOVED_SCHEMA = "rows int, differ binary, at binary, numbers binary"


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The rows of a task's batches (doubles) as blocks ``(column, row)``; a missing value is NaN."""
    held, rows = [], 0
    for batch in batches:
        held.append(np.stack([pc.fill_null(c, float("nan")).to_numpy() for c in batch.columns]))
        rows += batch.num_rows
        if rows >= ROWS_PER_BLOCK:
            yield np.concatenate(held, axis=1)
            held, rows = [], 0
    if rows:
        yield np.concatenate(held, axis=1)


def packed(block: np.ndarray) -> pa.RecordBatch:
    """A block as one row. ``differ`` has per column how many numbers are written, -1 for all."""
    rows = block.shape[1]
    bits = np.ascontiguousarray(block).view(np.int64)
    differ, places, numbers = [-1], [], [block[0]]
    for j in range(1, len(block)):
        at = np.append(np.flatnonzero(bits[j, :-1] != bits[j - 1, 1:]), rows - 1)
        few = len(at) < FEW * rows
        differ.append(len(at) if few else -1)
        places += [at.astype(np.int32)] if few else []
        numbers.append(block[j, at] if few else block[j])
    parts = [np.array(differ, np.int32), np.concatenate([np.zeros(0, np.int32), *places]), np.concatenate(numbers)]
    return one_row(rows, differ=parts[0], at=parts[1], numbers=parts[2])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The blocks that ``packed`` made, as they were."""
    for rows, differ, at, numbers in rows_of(batches, differ=np.int32, at=np.int32, numbers=np.float64):
        block = np.empty((len(differ), rows))
        place, number = 0, 0
        for j, many in enumerate(differ):
            if many < 0:
                block[j] = numbers[number : number + rows]
                number += rows
            else:
                block[j, :-1] = block[j - 1, 1:]
                block[j, at[place : place + many]] = numbers[number : number + many]
                place, number = place + many, number + many
        yield block


def one_row(rows: int, **values: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"rows": pa.array([rows], pa.int32()), **{c: pa.array([v.tobytes()], pa.binary()) for c, v in values.items()}})


def rows_of(batches: Iterator[pa.RecordBatch], **types: type) -> Iterator[tuple]:
    """The number of rows and the named values of each block."""
    for batch in batches:
        for k, rows in enumerate(batch["rows"].to_pylist()):
            yield rows, *[np.frombuffer(batch[c][k].as_buffer(), kind) for c, kind in types.items()]


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in block_rows(batches):
        yield packed(block)


def stored_packed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows of ``df`` (doubles) in packed blocks, and their folder."""
    return stored_blocks(df, _packing, MOVED_SCHEMA, name)


def stored_blocks(df: DataFrame, blocks: Callable, schema: str, name: str) -> tuple[DataFrame, str]:
    """Writes the blocks that ``blocks`` makes of the batches of ``df``; their scan and folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _settings(df):
        made = df.mapInArrow(blocks, schema)
        made.write.option("compression", "zstd").option("parquet.block.size", BLOCK_GROUP).parquet(path)
    return spark.read.schema(schema).parquet(path), path


def reduced(df: DataFrame, reduce: Callable, schema: str) -> list[Row]:
    """What ``reduce`` returns for the batches of each task, in a few tasks per core, so that little reaches the driver."""
    with _settings(df):
        return df.coalesce(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism).mapInArrow(reduce, schema).collect()


@contextmanager
def _settings(df: DataFrame) -> Iterator[None]:
    """For a table of blocks: batches of few rows, and tasks for all cores though the files are small."""
    spark = df.sparkSession
    wanted = {}
    if any(isinstance(f.dataType, T.BinaryType) for f in df.schema):
        tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": BLOCKS_PER_BATCH, "spark.sql.files.minPartitionNum": tasks}
    usual = {k: spark.conf.get(k, None) for k in wanted}
    try:  # read when the plan runs
        for k, v in wanted.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in usual.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
