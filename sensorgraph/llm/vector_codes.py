"""Vectors compressed to one byte per part, assigned with adaptive Drake-Hamerly bounds.

Vectors of whole numbers are cut into equal parts; every part position has a codebook, and a part is replaced by the
number of its nearest entry. Each round assigns all parts and moves every entry to the mean of its parts. Between rounds a
part keeps its ``b`` closest entries in order, with a lower bound of the distance to each and one outer bound for all other
entries. An entry that moved by ``m`` lowers its bound by ``m``, the outer bound falls by the largest move; a bound holds for
all entries behind it too. The distance to the part's own entry is computed anew in whole numbers, and so are those to the
entries whose bound does not exceed it; only if the outer bound does not either, all entries are compared. Bounds are
rounded to the safe side, so they only spare work; every decision is made by whole numbers, ties by the lower index.

``b`` follows the last round for each part position: it shrinks to what nearly all parts needed and doubles where many parts
had to compare all entries. The rows with their bounds are written once per round. What the driver holds are codebooks and
their sums: ``parts * entries`` rows, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgraph.llm.rows import arrow_rows, fixed_lists
from sensorgraph.operators.storage import delete, scratch_path, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries kept per part: at the start, at least, and at most as a share of all entries.
KEPT, LEAST_KEPT, MOST_KEPT = 16, 2, 4
#: Share of the parts that the kept entries should serve; the rest compares all entries.
SERVED = 0.98
_DOWN, _UP = 1 - 1e-12, 1 + 1e-12
_ROWS = 4096  # parts that are compared with all entries at once


class Codes(NamedTuple):
    """``rows``: id, label, ``code`` (entry per part) and ``error``; ``books``: (parts, entries, width) whole numbers."""

    rows: DataFrame
    books: np.ndarray


class Kept(NamedTuple):
    """What a part position's rows know: own entry, near entries in order, their lower bounds and the outer one last."""

    code: np.ndarray
    near: np.ndarray
    lower: np.ndarray


def finite(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    odd = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(True))


def whole(vector: str, scale: int) -> Column:
    """Components times ``scale``, rounded down."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every entry; exact for whole numbers within ``number_type``."""
    return (points * points).sum(1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(1)


def number_type(largest: int, width: int) -> type:
    """Doubles while all sums of products stay whole in them, because they multiply faster; else 64-bit integers."""
    reach = 8 * max(width, 1) * (largest + 1) ** 2
    if reach >= 1 << 62:
        raise ValueError(f"components up to {largest} are too large for distances of 64 bits")
    return np.float64 if reach < 1 << 53 else np.int64


def _ordered(lower: np.ndarray) -> np.ndarray:
    """A bound also holds for what stands behind it."""
    return np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]


def _all_compared(points: np.ndarray, book: np.ndarray, keep: int) -> tuple[Kept, np.ndarray]:
    n, k = len(points), len(book)
    code, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    near, lower = np.zeros((n, keep), np.int64), np.full((n, keep + 1), np.inf)
    for at in range(0, n, _ROWS):
        rows = slice(at, min(at + _ROWS, n))
        far = squared(points[rows], book)
        code[rows] = far.argmin(1)  # the first of equals
        here = np.arange(len(far))
        best[rows] = far[here, code[rows]]
        far = far.astype(np.float64)
        far[here, code[rows]] = np.inf
        take = min(keep + 1, k)
        closest = np.argpartition(far, take - 1, axis=1)[:, :take] if take else np.zeros((len(far), 0), np.int64)
        closest = np.take_along_axis(closest, np.take_along_axis(far, closest, 1).argsort(1), 1)
        bounds = np.sqrt(np.take_along_axis(far, closest, 1)) * _DOWN
        near[rows, : min(keep, take)] = closest[:, :keep]
        lower[rows, :take] = bounds
    return Kept(code, near, lower), best


def reassigned(points: np.ndarray, book: np.ndarray, moved: np.ndarray, kept: Kept, keep: int) -> tuple[Kept, np.ndarray, np.ndarray]:
    """New state with ``keep`` near entries, squared distances, and how many near entries each part needed (all: one more)."""
    code, near, lower = kept
    b = near.shape[1]
    lower = np.column_stack((lower[:, :b] - moved[near], lower[:, b:] - moved.max(initial=0.0)))
    lower = _ordered(lower)
    best = ((points - book[code]) ** 2).sum(1)
    needed = (lower <= (np.sqrt(best) * _UP)[:, None]).sum(1)
    some = np.flatnonzero((needed > 0) & (needed <= b))
    code, near, best = code.copy(), near.copy(), best.astype(np.int64)
    if len(some):
        most = int(needed[some].max())
        listed = np.column_stack((code[some], near[some]))
        exact = np.full(listed.shape, np.iinfo(np.int64).max, np.int64)
        exact[:, 0] = best[some]
        for j in range(1, most + 1):
            there = np.flatnonzero(needed[some] >= j)
            exact[there, j] = ((points[some[there]] - book[listed[there, j]]) ** 2).sum(1)
        order = np.lexsort((np.where(exact < np.iinfo(np.int64).max, listed, np.arange(b + 1)), exact))
        seen = np.take_along_axis(exact, order, 1)
        listed = np.take_along_axis(listed, order, 1)
        bounds = np.where(seen < np.iinfo(np.int64).max, np.sqrt(seen) * _DOWN, np.column_stack((np.zeros(len(some)), lower[some, :b])))
        code[some], near[some], best[some] = listed[:, 0], listed[:, 1:], seen[:, 0]
        lower[some, :b] = bounds[:, 1:]
        lower[some] = _ordered(lower[some])
    if keep < b:  # the bound of the first entry that is left out holds for the others too
        near, lower = near[:, :keep], lower[:, : keep + 1]
    elif keep > b:  # empty places have the outer bound, so that it is reached together with them
        near = np.pad(near, ((0, 0), (0, keep - b)))
        lower = np.column_stack((lower, np.repeat(lower[:, -1:], keep - b, axis=1)))
    every = np.flatnonzero(needed > b)
    if len(every):
        near, lower = near.copy(), lower.copy()
        fresh, best[every] = _all_compared(points[every], book, keep)
        code[every], near[every], lower[every] = fresh
    return Kept(code, near, lower), best, needed


def adapted(b: int, needed: np.ndarray, entries: int) -> int:
    """The next number of near entries, from how many parts needed 0, 1, ... b of them or (last) all entries."""
    most = max(1, entries // MOST_KEPT)
    if needed[-1] > (1 - SERVED) * needed.sum():
        return min(most, max(2 * b, LEAST_KEPT), max(entries - 1, 0))
    reach = np.cumsum(needed[:-1])
    return min(b, max(LEAST_KEPT, int(np.searchsorted(reach, SERVED * needed.sum()))))


def _round(books: np.ndarray, moved: np.ndarray, before: list[int], keep: list[int], kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One assignment of all parts; behind a task's rows come the sums and counts per entry and the needs per part."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        typed = books.astype(kind)
        sums = np.zeros((parts, entries, width + 1), np.int64)
        needs = [np.zeros(b + 2, np.int64) for b in before]
        like = None
        for batch in batches:
            like = batch.schema
            n = batch.num_rows
            points = fixed_lists(batch["point"], parts * width).reshape(n, parts, width)
            codes = fixed_lists(batch["code"], parts)
            nears, lowers = fixed_lists(batch["near"], sum(before)), fixed_lists(batch["lower"], sum(before) + parts)
            found, distances, at = [], np.zeros((n, parts), np.int64), 0
            for p, b in enumerate(before):
                kept = Kept(codes[:, p].astype(np.int64), nears[:, at : at + b].astype(np.int64), lowers[:, at + p : at + p + b + 1])
                at += b
                kept, distances[:, p], needed = reassigned(points[:, p].astype(kind), typed[p], moved[p], kept, keep[p])
                found.append(kept)
                needs[p] += np.bincount(needed, minlength=b + 2)
                for d in range(width):
                    sums[p, :, d] += np.bincount(kept.code, points[:, p, d], entries).astype(np.int64)
                sums[p, :, width] += np.bincount(kept.code, minlength=entries)
            state = {
                "code": np.stack([x.code for x in found], 1).astype(np.int16), "near": np.concatenate([x.near for x in found], 1).astype(np.int16),
                "lower": np.concatenate([x.lower for x in found], 1), "distance": distances,
            }
            yield arrow_rows(batch.schema, {c: batch[c] for c in ("id", "label", "point")} | {c: _lists(v) for c, v in state.items()}, n)
        if like is not None:
            tallies = [*sums.reshape(-1, width + 1).tolist(), *[x.tolist() for x in needs]]
            numbers = [*range(parts * entries), *[-1 - p for p in range(parts)]]
            yield arrow_rows(like, {"tally": pa.array(numbers, pa.int32()), "sums": pa.array(tallies, pa.list_(pa.int64()))}, len(numbers))

    return run


def _lists(rows: np.ndarray) -> pa.Array:
    starts = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    return pa.ListArray.from_arrays(starts, pa.array(np.ascontiguousarray(rows).ravel()))


def compress(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codes:
    """Codes of all vectors whose components are all there and finite; other rows are left out, so are other columns.

    Codebooks start as the parts of the ``entries`` smallest ids, or of all vectors if fewer; null ids come last, equal ids
    by their vectors. Repeated rows count as often as they stand there. All vectors have one length, a multiple of ``parts``;
    else it raises, as it does for components beyond about 2**24 in whole numbers. An empty table has no rows and empty
    codebooks.
    """
    spark = df.sparkSession
    if not 0 < entries <= 1 << 15:
        raise ValueError("entries must be between 1 and 32768")
    points = df.where(finite(vector_col)).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole(vector_col, scale).alias("point")
    )
    points = stored(points, "vector-points")
    reach = F.array_max(F.transform("point", F.abs))
    shortest, longest, largest = points.agg(F.min(F.size("point")), F.max(F.size("point")), F.max(reach)).first()
    if shortest is None:
        none = points.select("id", "label", F.array().cast("array<smallint>").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(none, np.zeros((parts, 0, 0), np.int64))
    if shortest != longest or longest % parts:
        raise ValueError(f"vectors of {shortest} to {longest} components cannot be cut into {parts} equal parts")
    width = longest // parts
    kind = number_type(largest or 0, width)
    first = [r["point"] for r in points.orderBy(F.col("id").asc_nulls_last(), "point").select("point").limit(entries).collect()]
    books = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    entries = len(first)
    before, keep = [0] * parts, [min(KEPT, entries - 1)] * parts
    moved = np.zeros((parts, entries))
    state = points.withColumns(
        {
            "code": F.array_repeat(F.lit(0).cast("smallint"), parts),
            "near": F.array().cast("array<smallint>"),
            "lower": F.array_repeat(F.lit(float("-inf")), parts),  # nothing known: all entries are compared
            "distance": F.array().cast("array<bigint>"),
            "tally": F.lit(None).cast("int"),
            "sums": F.lit(None).cast("array<bigint>"),
        }
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema])
    old = None
    for k in range(rounds + 1):
        path = scratch_path(spark, "vector-codes")
        state.mapInArrow(_round(books, moved, before, keep, kind), schema).write.parquet(path)
        written = spark.read.schema(schema).parquet(path)
        if old:
            delete(spark, old)
        state, old = written.where("tally is null"), path
        if k == rounds:
            break
        each = written.where("tally is not null").select("tally", F.posexplode("sums").alias("place", "number"))
        sums = np.zeros((parts, entries, width + 1), np.int64)
        needs = [np.zeros(b + 2, np.int64) for b in before]
        for tally, place, number in each.groupBy("tally", "place").agg(F.sum("number")).collect():
            p, entry = divmod(tally, entries) if tally >= 0 else (-1 - tally, None)
            (needs[p] if entry is None else sums[p, entry])[place] = number
        count = sums[:, :, width:]
        means = np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), books)
        moved = np.sqrt(((means - books).astype(np.float64) ** 2).sum(2)) * _UP
        books = means
        before, keep = keep, [adapted(b, needs[p], entries) if b else keep[p] for p, b in enumerate(before)]
    error = F.aggregate("distance", F.lit(0).cast("long"), lambda a, x: a + x)
    return Codes(state.select("id", "label", "code", error.alias("error")), books)


def hex_code(column: str = "code") -> Column:
    """The entries' numbers, two lower-case hex digits each (for up to 256 entries)."""
    return F.array_join(F.transform(column, lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``, the error of all rows of their label; rows without a label count as one label.

    The sums are stored, so their size decides how they are joined; a label of many rows is summed per task first.
    """
    sums = stored(rows.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def decompress(rows: DataFrame, books: np.ndarray, out: str = "vector", scale: int = SCALE) -> DataFrame:
    """Adds the vector that a code stands for: the middle of its entries' cells."""
    table = F.lit(None).cast("array<array<double>>") if books.size == 0 else F.array(
        *[F.array(*[F.lit(x) for x in ((books[p].ravel() + 0.5) / scale).tolist()]) for p in range(len(books))]
    )
    width = F.lit(books.shape[2])
    entry = lambda e, p: F.slice(F.get(table, p), e.cast("int") * width + 1, width)
    return rows.withColumn(out, F.flatten(F.transform("code", entry)))
