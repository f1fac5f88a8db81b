"""Gradient-boosted regression trees by histograms of binned blocks.

The same trees as Spark's ``GBTRegressor`` grows (squared error, the first tree on the labels, each further one on twice
the residuals with the learning rate as its weight, variance gain, candidate thresholds by equal shares), from all rows.
Spark keeps every row as objects and reads them once a level from disk where they exceed the memory. Here features are
written once as bytes, some ten thousand rows in a block, and a level of a tree is one pass of NumPy over the blocks: its
result is a table of counts and sums per node, feature and bin. Thresholds are taken from a weighted summary of all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.operators import blocks
from sensorgraph.operators.storage import delete

#: Candidate thresholds of a feature at most, plus one: bins.
BINS = 32
#: Points of a feature's summary: a share of the rows is off by a thousandth at most each time it is made smaller.
POINTS = 1024
#: Trees whose part in the residuals is computed anew in every pass, until residuals are written again.
TREES_PER_WRITE = 3
BLOCK_SCHEMA = "rows int, codes binary, rest binary"


class Tree(NamedTuple):
    """A complete binary tree, children of ``i`` at ``2 i + 1`` and ``2 i + 2``.

    A row goes left if its bin is at most ``bins``. Below a node that is not split all rows go left to the same value.
    """

    split: np.ndarray
    features: np.ndarray
    bins: np.ndarray
    values: np.ndarray
    gains: np.ndarray
    counts: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.zeros(n, bool), np.zeros(n, np.intp), np.full(n, 255, np.uint8), np.zeros(n), np.zeros(n), np.zeros(n))


def nodes_of(tree: Tree, codes: np.ndarray, level: int) -> np.ndarray:
    """The node of every row at a level."""
    rows = codes.shape[1]
    flat, at = codes.reshape(-1), np.arange(rows)
    node = np.zeros(rows, np.intp)
    starts = tree.features * rows
    for k in range(level):
        code = codes[tree.features[0]] if k == 0 else flat.take(starts.take(node) + at)
        limit = tree.bins[0] if k == 0 else tree.bins.take(node)
        node = 2 * node + 1 + (code > limit)
    return node


def residuals(trees: Sequence[tuple[Tree, float]], codes: np.ndarray, rest: np.ndarray, depth: int) -> np.ndarray:
    for tree, weight in trees:
        rest = rest - weight * tree.values.take(nodes_of(tree, codes, depth))
    return rest


def smaller(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with their weights; beyond ``POINTS`` of them, as many of equal weight."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.intp)
    values, weights = values[starts], np.add.reduceat(weights, starts) if len(starts) else weights
    if len(values) > POINTS:
        reached = np.cumsum(weights)
        ranks = reached[-1] * (np.arange(POINTS) + 0.5) / POINTS
        values = values[np.minimum(np.searchsorted(reached, ranks), len(values) - 1)]
        return smaller(values, np.full(POINTS, reached[-1] / POINTS))
    return values, weights


def thresholds_of(values: np.ndarray, weights: np.ndarray, most: int = BINS - 1) -> np.ndarray:
    """Spark's choice: between all neighbours if they are few, else where equal shares of the weight end."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = weights.sum() / (most + 1)
    reached, target, found = np.cumsum(weights), stride, []
    for i in range(1, len(values)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            found.append(middle[i - 1])
            target += stride
    return np.array(found[:most])


def _summaries(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0), np.zeros(0))] * width
        rows = 0
        for block in blocks.unpacked(batches):
            rows += block.shape[1]
            if np.isnan(block[width]).any():
                raise ValueError("a label is missing")
            for j in range(width):
                known = block[j][~np.isnan(block[j])] + 0.0  # no negative zeros
                kept[j] = smaller(*(np.concatenate(p) for p in zip(kept[j], (known, np.ones(len(known))), strict=True)))
        if rows:
            points = {c: pa.array([[k[i].tobytes() for k in kept]], pa.list_(pa.binary())) for i, c in enumerate(("points", "weights"))}
            yield pa.record_batch({"rows": pa.array([rows], pa.int64()), **points})

    return run


def _binned(thresholds: list[np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.unpacked(batches):
            codes = np.stack([np.searchsorted(t, v).astype(np.uint8) for t, v in zip(thresholds, block, strict=False)])
            yield blocks.one_row(block.shape[1], codes=codes, rest=block[-1])

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for rows, codes, rest in blocks.rows_of(batches, codes=np.uint8, rest=np.float64):
        yield codes.reshape(-1, rows), rest


def _advanced(trees: list, depth: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, rest in _read(batches):
            yield blocks.one_row(len(rest), codes=codes, rest=residuals(trees, codes, rest, depth))

    return run


def _histograms(trees: list, tree: Tree, level: int, slots: np.ndarray, scale: float, width: int, depth: int) -> Callable:
    """Counts and sums of the nodes of a level that have a slot, per feature and bin, as one row of numbers."""
    many = int(slots.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Two features at once, per pair of bins: that takes half the sums, and each one's are the pairs' totals.
        pairs, single = np.zeros((2, width // 2, many * BINS * BINS)), np.zeros((2, many * BINS))
        for codes, rest in _read(batches):
            goal = scale * residuals(trees, codes, rest, depth)
            slot = slots.take(nodes_of(tree, codes, level))
            if (slots[2**level - 1 : 2 ** (level + 1) - 1] < 0).any():
                inside = np.flatnonzero(slot >= 0)
                codes, goal, slot = codes.take(inside, axis=1), goal[inside], slot[inside]
            start = slot * (BINS * BINS)
            for j in range(width // 2):
                place = start + (codes[2 * j].astype(np.uint16) * np.uint16(BINS) + codes[2 * j + 1])
                pairs[0, j] += np.bincount(place, minlength=pairs.shape[2])
                pairs[1, j] += np.bincount(place, goal, pairs.shape[2])
            if width % 2:
                place = slot * BINS + codes[-1]
                single += np.bincount(place, minlength=many * BINS), np.bincount(place, goal, many * BINS)
        pairs = pairs.reshape(2, width // 2, many, BINS, BINS)
        found = np.stack([pairs.sum(axis=4), pairs.sum(axis=3)], axis=2).reshape(2, -1, many, BINS)
        if width % 2:
            found = np.concatenate([found, single.reshape(2, 1, many, BINS)], axis=1)
        yield pa.record_batch({"found": pa.array([found.tobytes()])})

    return run


def best_split(found: np.ndarray, bins: list[int]) -> tuple[float, int, int]:
    """Gain, feature and bin of the best split of a node from its counts and sums ``(2, feature, bin)``."""
    left = np.cumsum(found, axis=2)[:, :, :-1]
    total = found.sum(axis=2)[:, :, None]
    right = total - left
    usable = (left[0] >= 1) & (right[0] >= 1) & (np.arange(BINS - 1)[None] < np.array(bins)[:, None] - 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(usable, (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - total[1] ** 2 / total[0]) / total[0], 0.0)
    feature, at = np.unravel_index(np.argmax(gain), gain.shape)
    return float(gain[feature, at]), int(feature), int(at)


def grow(histograms: Callable[[Tree, int, np.ndarray], np.ndarray], depth: int, bins: list[int]) -> Tree:
    """A tree, level by level. Of two children only the one with fewer rows is summed; the other is what is left."""
    tree = Tree.empty(depth)
    slots = np.full(len(tree.split), -1, np.intp)
    slots[0] = 0
    known = {0: histograms(tree, 0, slots)[:, :, 0]}
    for level in range(depth):
        wanted = []
        for node, found in known.items():
            rows, total = found[:, 0].sum(axis=1)
            if level == 0:
                tree.counts[0], tree.values[0] = rows, total / rows
            gain, feature, at = best_split(found, bins)
            # What rounding leaves of a sum is no gain.
            if gain > 1e-12 * (tree.values[node] ** 2):
                tree.split[node], tree.features[node], tree.bins[node], tree.gains[node] = True, feature, at, gain
                part = found[:, feature, : at + 1].sum(axis=1)
                for child, (n, s) in ((2 * node + 1, part), (2 * node + 2, (rows - part[0], total - part[1]))):
                    tree.counts[child], tree.values[child] = n, s / n
                wanted.append(node)
        below = 2 ** (level + 1) - 1
        for child in range(below, min(2 * below + 1, len(tree.split))):
            parent = (child - 1) // 2
            if not tree.split[parent]:
                tree.values[child], tree.counts[child] = tree.values[parent], tree.counts[parent]
        if level + 1 == depth or not wanted:
            continue
        less = [2 * n + 1 if tree.counts[2 * n + 1] <= tree.counts[2 * n + 2] else 2 * n + 2 for n in wanted]
        slots = np.full(len(tree.split), -1, np.intp)
        slots[less] = np.arange(len(less))
        summed, above, known = histograms(tree, level + 1, slots), known, {}
        for k, (parent, child) in enumerate(zip(wanted, less, strict=True)):
            known[child] = summed[:, :, k]
            known[4 * parent + 3 - child] = above[parent] - summed[:, :, k]
        known = dict(sorted(known.items()))
    if not tree.split[0]:
        tree.values[:] = tree.values[0]
    # A node without rows below a leaf repeats its value, level by level.
    for node in range(1, len(tree.split)):
        if not tree.split[(node - 1) // 2]:
            tree.values[node] = tree.values[(node - 1) // 2]
    return tree


def fit_boosted_trees(train: DataFrame, features: Sequence[str], label: str, rounds: int, depth: int, rate: float = 0.1) -> tuple[list[Tree], list[np.ndarray]]:
    """Trees (the first has weight 1, the others ``rate``) and the thresholds per feature."""
    spark, width = train.sparkSession, len(features)
    samples, unbinned = blocks.stored_packed(train.select(*[F.col(c).cast("double") for c in (*features, label)]), "samples")
    parts = blocks.reduced(samples, _summaries(width), "rows long, points array<binary>, weights array<binary>")
    if not parts:
        raise ValueError("there is nothing to fit a forecaster on")
    thresholds = []
    total = sum(p["rows"] for p in parts)
    for j in range(width):
        values, weights = smaller(*(np.concatenate([np.frombuffer(p[c][j]) for p in parts]) for c in ("points", "weights")))
        thresholds.append(thresholds_of(values, weights, min(BINS, total) - 1))
    bins = [len(t) + 1 for t in thresholds]
    binned, path = blocks.stored_blocks(samples, _binned(thresholds), BLOCK_SCHEMA, "binned")
    delete(spark, unbinned)
    # So few rows are read here instead of a job for every level.
    small = total <= blocks.ROWS_PER_BLOCK
    here = binned.toArrow().to_batches() if small else []
    trees, pending = [], []

    def histograms(tree: Tree, level: int, slots: np.ndarray) -> np.ndarray:
        passed = _histograms(pending, tree, level, slots, 2.0 if trees else 1.0, width, depth)
        shape = (2, width, int(slots.max()) + 1, BINS)
        parts = [b["found"][0].as_py() for b in passed(iter(here))] if small else [r["found"] for r in blocks.reduced(binned, passed, "found binary")]
        return sum(np.frombuffer(part).reshape(shape) for part in parts)

    for i in range(rounds):
        if len(pending) == TREES_PER_WRITE and small:
            here, pending = list(_advanced(pending, depth)(iter(here))), []
        elif len(pending) == TREES_PER_WRITE:
            before = path
            binned, path = blocks.stored_blocks(binned, _advanced(pending, depth), BLOCK_SCHEMA, "binned")
            delete(spark, before)
            pending = []
        tree = grow(histograms, depth, bins)
        trees.append(tree)
        pending = [*pending, (tree, rate if i else 1.0)]
    delete(spark, path)
    return trees, thresholds


def spark_model(spark, regressor, trees: list[Tree], thresholds: list[np.ndarray], rate: float = 0.1) -> GBTRegressionModel:
    """The trees as Spark's own model with the settings of ``regressor``. Impurities of nodes are not kept (-1)."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    leaf, inner, threshold = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    doubles = lambda numbers: _java_array(gateway, jvm.double, numbers)

    def node(tree: Tree, i: int):
        count, value = float(tree.counts[i]), float(tree.values[i])
        stats = calculator(doubles([count, count * value, -1.0]), int(count))
        if not tree.split[i]:
            return leaf(value, -1.0, stats)
        feature = int(tree.features[i])
        split = threshold(feature, float(thresholds[feature][tree.bins[i]]))
        return inner(value, -1.0, float(tree.gains[i]), node(tree, 2 * i + 1), node(tree, 2 * i + 2), split, stats)

    width = len(thresholds)
    grown = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for k, tree in enumerate(trees):
        grown[k] = ml.regression.DecisionTreeRegressionModel(f"{regressor.uid}_{k}", node(tree, 0), width)
    weights = doubles([1.0] + [rate] * (len(trees) - 1))
    return regressor._copyValues(GBTRegressionModel(ml.regression.GBTRegressionModel(regressor.uid, grown, weights, width)))


def _java_array(gateway, kind, numbers):
    array = gateway.new_array(kind, len(numbers))
    for i, x in enumerate(numbers):
        array[i] = x
    return array
