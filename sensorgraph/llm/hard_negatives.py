"""Hard negatives by Fagin's threshold algorithm over lists sorted by dimension.

Rows are cut into shards; a shard has, for every dimension, the list of its rows sorted by their component. An anchor reads
each list from the end that its own component's sign prefers, in steps that double. A row that turns up for the first time
is scored at once, as a whole inner product of integers. The sum of the anchor's components times the values reached in the
lists is the threshold: no row that has not turned up scores more. Reading stops once the threshold is strictly below what
every window still asks for, which is the score of its last place, or its lower edge while it has places left.

A first pass finds the anchors' positives, a second one the negatives within each positive's window. Anchors are the stated
query set: they go in blocks of ``ANCHOR_BYTES`` through one pass over all rows each, broadcast as a block of that bounded
size. A task keeps the best rows of each anchor over all its shards and returns only those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgraph.llm.rows import fixed_lists
from sensorgraph.llm.vector_codes import finite, number_type, whole
from sensorgraph.operators.panel import dense_index
from sensorgraph.operators.storage import stored

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative scores at least so many hundredths of its positive.
LEAST_PERCENT = 80
#: Rows whose lists are sorted together, bytes of an anchor block, and rows read from every list in the first step.
SHARD_ROWS, ANCHOR_BYTES, FIRST_STEP = 1 << 15, 16 << 20, 32


class Shard:
    """Rows and, for every dimension, their order by its component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, kind: type):
        self.ids, self.labels, self.points = ids, labels, points.astype(kind)
        self.order = np.argsort(points, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.ascontiguousarray(np.take_along_axis(points, self.order.T, 0).T.astype(kind))

    def unread(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rows that turn up for the first time, their scores, and the threshold for all others."""
        n, up, down = len(self.ids), np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, at, step = np.zeros(n, bool), 0, FIRST_STEP
        while at < n:
            end = min(n, at + step)
            read = np.zeros(n, bool)
            read[self.order[up, n - end : n - at]] = True
            read[self.order[down, at:end]] = True
            rows = np.flatnonzero(read & ~seen)
            seen[rows] = True
            threshold = anchor[up] @ self.sorted[up, n - end] + anchor[down] @ self.sorted[down, end - 1]
            yield rows, self.points[rows] @ anchor, threshold
            if not len(up) and not len(down):  # all scores are 0 and no list is worth reading
                rest = np.flatnonzero(~seen)
                yield rest, np.zeros(len(rest)), -np.inf
            if seen.all():
                return
            at, step = end, 2 * step


class Best:
    """The best rows with scores from ``low`` to ``high``, ties by smaller id; ``asks`` is what a further row must reach."""

    def __init__(self, places: int, low: float, high: float):
        self.places, self.asks, self.high = places, low, high
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.asks) & (scores <= self.high)
        if not fit.any():
            return
        scores, ids = np.concatenate((self.scores, scores[fit])), np.concatenate((self.ids, ids[fit]))
        if len(scores) > self.places:
            last = np.partition(scores, len(scores) - self.places)[len(scores) - self.places]
            scores, ids = scores[near := scores >= last], ids[near]
        first = np.lexsort((ids, -scores))[: self.places]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.places:
            self.asks = self.scores[-1]


def search(shard: Shard, anchor: np.ndarray, fits: np.ndarray, windows: list[Best]) -> int:
    """Adds a shard's rows to the windows; returns how many rows were scored."""
    scored = 0
    for rows, scores, threshold in shard.unread(anchor):
        scored += len(rows)
        rows, scores = rows[mine := fits[rows]], scores[mine]
        for window in windows:
            window.add(scores, shard.ids[rows])
        if all(threshold < window.asks for window in windows):
            break
    return scored


def _shards(batches: Iterator[pa.RecordBatch], width: int, kind: type) -> Iterator[Shard]:
    parts, held = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, SHARD_ROWS):
            part = batch.slice(at, SHARD_ROWS)
            if held and held + part.num_rows > SHARD_ROWS:
                yield Shard(*[np.concatenate(x) for x in zip(*parts, strict=True)], kind)
                parts, held = [], 0
            parts.append((part["id"].to_numpy(), part["label"].to_numpy(), fixed_lists(part["point"], width)))
            held += part.num_rows
    if held:
        yield Shard(*[np.concatenate(x) for x in zip(*parts, strict=True)], kind)


def _searched(anchors: dict, same: bool, places: int, percent: int | None, width: int, kind: type) -> Callable:
    """Per task and anchor of the block: the best rows of its label, or of other labels within each positive's window."""

    def windows(k: int) -> list[Best]:
        if percent is None:
            return [Best(places, -np.inf, np.inf)]
        return [Best(places, -(-percent * score // 100), score) for score in anchors["windows"][k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [windows(k) for k in range(len(anchors["id"]))]
        for shard in _shards(batches, width, kind):
            for k, (own, label, anchor) in enumerate(zip(anchors["id"], anchors["label"], anchors["point"], strict=True)):
                fits = (shard.labels == label) & (shard.ids != own) if same else shard.labels != label
                if fits.any():
                    search(shard, anchor.astype(kind), fits, held[k])
        found = [(anchors["number"][k], int(w.high) if percent else 0, i, s) for k, ws in enumerate(held) for w in ws for i, s in zip(w.ids, w.scores, strict=True)]
        columns = [pa.array([int(row[c]) for row in found], pa.int64()) for c in range(4)]
        yield pa.record_batch(columns, names=["number", "positive_score", "id", "score"])

    return run


def _first(found: DataFrame, keys: list[str], places: int, out: str) -> DataFrame:
    """The best rows per key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn(out, F.row_number().over(order)).where(F.col(out) <= places)


def _in_blocks(rows: DataFrame, anchors: DataFrame, count: int, per_block: int, width: int, kind: type, same: bool, places: int, percent: int | None) -> DataFrame | None:
    """One pass over ``rows`` per block of anchors, each written, with a broadcast of the block's bounded size."""
    context, found = rows.sparkSession.sparkContext, []
    for start in range(0, count, per_block):
        near = (F.col("number") >= start) & (F.col("number") < start + per_block)
        block = anchors.where(near).orderBy("number").toArrow()
        if not block.num_rows:
            continue
        sent = {c: block[c].to_numpy() for c in ("number", "id", "label")} | {"point": fixed_lists(block["point"].combine_chunks(), width)}
        if percent is not None:
            sent["windows"] = block["windows"].to_pylist()
        shared = context.broadcast(sent)
        task = lambda batches, shared=shared: _searched(shared.value, same, places, percent, width, kind)(batches)
        found.append(stored(rows.mapInArrow(task, "number long, positive_score long, id long, score long"), "anchor-block"))
        shared.unpersist()
    return reduce(DataFrame.unionByName, found) if found else None


def hard_negatives(
    df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, scale: int = SCALE, anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """Per anchor, positive and rank: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    ``is_anchor`` is a condition on the id column. Components become whole numbers times ``scale``, rounded down. Positives
    are the best rows of the anchor's label with another id, negatives the best rows of other labels that score from
    ``least_percent`` hundredths of the positive up to the positive; ties go to the smaller id. Rows without id or label,
    or whose vector or a component of it is missing or not finite, take no part. A repeated row takes part as often as it
    stands there: it fills several places, and each copy of an anchor has rows of its own. Labels are whole numbers. All
    vectors have one length, else it raises; an empty table has no rows; other columns are left out.
    """
    spark = df.sparkSession
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(vector_col)
    rows = df.where(usable).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        whole(vector_col, scale).alias("point"), is_anchor.alias("is_anchor"),
    )
    rows = stored(rows, "mining-rows")
    largest = F.max(F.array_max(F.transform("point", F.abs)))
    shortest, longest, reach = rows.agg(F.min(F.size("point")), F.max(F.size("point")), largest).first()
    if shortest != longest:
        raise ValueError(f"vectors have {shortest} to {longest} components")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    empty = spark.createDataFrame([], schema)
    if not longest:
        return empty
    kind = number_type(reach, longest)
    anchors = stored(dense_index(rows.where("is_anchor").select("id", "label", "point"), ["id", "label", "point"], "number"), "anchors")
    count, per_block = anchors.count(), max(1, anchor_bytes // (8 * (longest + positives + 3)))
    rows = rows.drop("is_anchor")
    best = _in_blocks(rows, anchors, count, per_block, longest, kind, True, positives, None)
    if best is None:
        return empty
    found = _first(best.drop("positive_score"), ["number"], positives, "place")
    found = stored(found.select("number", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = found.groupBy("number").agg(F.sort_array(F.collect_set("positive_score")).alias("windows"))
    asking = stored(anchors.join(windows, "number"), "anchors-with-windows")
    best = _in_blocks(rows, asking, count, per_block, longest, kind, False, negatives, least_percent)
    if best is None:
        return empty
    taken = _first(best, ["number", "positive_score"], negatives, "rank")
    named = found.join(anchors.select("number", F.col("id").alias("anchor_id")), "number")
    return named.join(taken, ["number", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
