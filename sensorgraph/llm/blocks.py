"""Blocks of documents in the shared folder, and the exchange that tells each block how frequent its codes are.

A block is a file with the ids and texts of some documents, written once. Tasks that need the texts again read the
file, so texts are never shuffled; what moves are codes of 8 bytes, packed per block and bucket.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.llm.text import byte_column
from sensorgraph.operators.storage import scratch_path, stored

BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 512 << 10
CODE_BYTES = 5  # of a code's 8; the highest are its bucket


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def bucket_bits(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets in proportion to the input, as a power of two; at least 256.

    Blocks grow with the input too, and each has a row per bucket: small buckets make many rows of few codes.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(40, max(8, (size // bucket_bytes).bit_length()))


def by_bucket(codes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Bucket and range of sorted codes."""
    bucket = codes >> np.uint64(64 - bits)
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(bucket[a]), a, b


def packed(codes: np.ndarray) -> bytes:
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES]).tobytes()


def unpacked(payload: bytes) -> np.ndarray:
    out = np.zeros((len(payload) // CODE_BYTES, 8), np.uint8)
    out[:, :CODE_BYTES] = np.frombuffer(payload, np.uint8).reshape(-1, CODE_BYTES)
    return out.view("<u8").ravel()


def code_rows(block: str, codes: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted codes as one row per bucket; a row of bucket -1 if there are none."""
    rows = [(k, packed(codes[a:b])) for k, a, b in by_bucket(codes, bits)] if len(codes) else [(-1, b"")]
    columns = [pa.array([block] * len(rows)), pa.array([k for k, _ in rows], pa.int64()), pa.array([p for _, p in rows], pa.binary())]
    return pa.record_batch(columns, ["block", "bucket", "payload"])


def doubled(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Sorted distinct codes, those of several documents twice."""
    order = np.lexsort((doc, codes))
    codes, doc = codes[order], doc[order]
    new = np.concatenate(([True], codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    several = np.zeros(len(first), bool)
    several[group[doc != doc[first][group]]] = True
    return np.repeat(codes[first], 1 + several)


def read_block(path: str) -> pa.Table:
    system, place = file_system(path)
    with system.open_input_file(place) as file:
        return pq.read_table(file)


def block_texts(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (null as the smallest number), bytes and offsets of a block's texts."""
    data, offsets = byte_column(block.column("text").combine_chunks())
    ids = block.column("id").combine_chunks().fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
    return ids, data, offsets


def write_blocks(docs: DataFrame, id_col: str, text_col: str, codes_of: Callable, bits: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Writes the blocks; returns ``block, bucket, payload``: the sorted codes of each block by bucket.

    ``codes_of(ids, data, offsets)`` gives sorted codes of a block, one that two of its documents share twice. A block
    without codes has a row of bucket -1 and no payload, so that every block is listed. The result is written too: file
    names carry the task attempt, and the rows that count are those of the attempt that was committed.
    """
    folder = scratch_path(docs.sparkSession, "blocks")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, place = file_system(folder)
        system.create_dir(place, recursive=True)
        waiting, size, number = [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal waiting, size, number
            name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{number:05d}.parquet"
            block = pa.Table.from_batches(waiting)
            with system.open_output_stream(f"{place}/{name}", compression=None) as out:
                pq.write_table(block, out, compression="zstd", compression_level=6, use_dictionary=False, write_statistics=False)
            waiting, size, number = [], 0, number + 1
            codes = codes_of(*block_texts(block))
            return code_rows(f"{folder}/{name}", codes, bits)

        for batch in batches:
            for part in _split(batch, block_bytes):
                waiting.append(part)
                size += part.get_total_buffer_size() if part.num_rows == 1 else part.nbytes
                if size >= block_bytes:
                    yield close()
        if waiting:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return stored(rows.mapInArrow(run, "block string, bucket long, payload binary"), "block-codes")


def _split(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1) / 2))
    for a in range(0, batch.num_rows, step):
        yield batch.slice(a, step)


def code_levels(codes: DataFrame) -> DataFrame:
    """``block, bucket, levels``: per code of a row a byte, 1 + the whole logarithm of its count in all blocks."""

    def run(group: pa.Table) -> pa.Table:
        parts = [unpacked(p.as_py()) for p in group.column("payload")]
        _, where, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        level = (1 + np.log2(count)).astype(np.uint8)[where]
        ends = np.cumsum([len(p) for p in parts])
        out = [zlib.compress(level[b - len(p) : b].tobytes(), 1) for p, b in zip(parts, ends.tolist(), strict=True)]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "levels": pa.array(out, pa.binary())})

    found = codes.where("bucket >= 0").groupBy("bucket").applyInArrow(run, "block string, bucket long, levels binary")
    alone = codes.where("bucket < 0").select("block", "bucket", F.col("payload").alias("levels"))
    return found.unionByName(alone)


def levels_of(group: pa.Table, codes: np.ndarray, bits: int) -> np.ndarray:
    """The levels of a block's rows in the order of its sorted codes."""
    rows = dict(zip(group.column("bucket").to_pylist(), group.column("levels").to_pylist(), strict=True))
    parts = [np.frombuffer(zlib.decompress(rows[k]), np.uint8) for k, _, _ in by_bucket(codes, bits)] if len(codes) else []
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)
