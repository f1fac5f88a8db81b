"""Linear regression with Huber loss and a fitted scale, in few passes over packed blocks.

The objective is that of Spark's ``LinearRegression(loss="huber")`` without regularisation: the sum over all rows of
``sigma + sigma * H(residual / sigma)``, jointly in the coefficients, the intercept and ``sigma``. It is convex and smooth
between the rows that change sides, so Newton steps need a few passes where Spark's quasi-Newton steps need up to fifty,
each over all rows as dense vectors. A pass returns the moments of the rows within the bend and the sums of those outside,
and the objective at shorter steps, from which the next step is chosen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.operators import blocks
from sensorgraph.operators.storage import delete

#: Shares of a step that are tried in one pass.
SHARES = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001)
#: By how much the scale changes in a step at most (less after a step that gains nothing, down to the second number), and the
#: least scale as a share of the largest label.
MOST_CHANGE, LEAST_CHANGE, LEAST_SCALE = 10.0, 1.2, 1e-12
#: Rows that are multiplied at a time, for the processor's cache.
AT_ONCE = 4096


def objective(rest: np.ndarray, scale: float, bend: float) -> float:
    size = np.abs(rest)
    return float(np.where(size <= bend * scale, rest * rest / scale + scale, 2 * bend * size + (1 - bend * bend) * scale).sum())


def _pieces(whole: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    for block in whole:
        for k in range(0, block.shape[1], AT_ONCE):
            yield block[:, k : k + AT_ONCE]


def _moments(start: np.ndarray, step: np.ndarray, bend: float) -> Callable:
    """One row of numbers for the parameters ``start + step`` (coefficients, intercept, scale): rows, objective per share of
    the step, moments of ``(x, 1, residual)`` within the bend, rows outside, and sums of ``sign * (x, 1)`` there."""
    width = len(start) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, outside, losses, largest = 0, 0, np.zeros(len(SHARES)), 0.0
        inner, outer = np.zeros((width + 2, width + 2)), np.zeros(width + 1)
        for block in _pieces(blocks.unpacked(batches)):
            x, label = block[:width], block[width]
            if not np.isfinite(block.sum()) and not np.isfinite(block).all():
                raise ValueError("a feature or label is missing or not finite")
            before = label - start[:width] @ x - start[width]
            moved = step[:width] @ x + step[width]
            for k, share in enumerate(SHARES if step.any() else SHARES[:1]):
                losses[k] += objective(before - share * moved, start[-1] + share * step[-1], bend)
            rest = before - moved
            far = np.abs(rest) > bend * (start[-1] + step[-1])
            sign = np.sign(rest[far])
            rows, outside, largest = rows + len(rest), outside + len(sign), max(largest, float(np.abs(label).max()))
            outer += np.append(x[:, far] @ sign, sign.sum())
            near = np.concatenate([x, np.ones((1, len(rest))), rest[None]])
            near *= ~far
            inner += near @ near.T
        if rows:
            yield pa.record_batch({"found": pa.array([np.concatenate([[rows, outside, largest], losses, inner.ravel(), outer]).tobytes()])})

    return run


class _Sums:
    """What the tasks of a pass found, at the parameters ``at``."""

    def __init__(self, parts: list[np.ndarray], at: np.ndarray, bend: float):
        width = len(at) - 2
        found = np.array(parts)
        self.at, self.bend, self.largest = at, bend, found[:, 2].max()
        total = found.sum(axis=0)
        self.rows, self.outside, self.losses = total[0], total[1], total[3 : 3 + len(SHARES)]
        rest = total[3 + len(SHARES) :]
        self.inner, self.outer = rest[: (width + 2) ** 2].reshape(width + 2, width + 2), rest[(width + 2) ** 2 :]

    def newton(self, change: float) -> np.ndarray:
        """The step to where the square that fits the objective here is least."""
        scale, bend = self.at[-1], self.bend
        linear = -2 * (self.inner[:-1, -1] / scale + bend * self.outer)
        own = (self.rows - self.outside) - self.inner[-1, -1] / scale**2 + (1 - bend**2) * self.outside
        # Second derivatives of r * r / scale: 2 / scale * u u' with u = (x, 1, r / scale).
        weight = np.append(np.ones(len(linear)), 1 / scale)
        curve = 2 / scale * self.inner * weight * weight[:, None]
        step = -solved(curve, np.append(linear, own))
        # Where the scale may not move as far as that, the coefficients step as with the scale that is reached.
        reached = np.clip(scale + step[-1], scale / change, scale * change)
        if reached != scale + step[-1]:
            step = np.append(-solved(curve[:-1, :-1], linear), reached - scale)
        return step


def solved(square: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The shortest solution after every column is brought to the same size; columns without rows get 0."""
    size = np.sqrt(np.diag(square))
    size = np.where(size > 0, size, 1.0)
    return np.linalg.lstsq(square / size / size[:, None], right / size, rcond=1e-12)[0] / size


def fit_huber(train: DataFrame, features: Sequence[str], label: str, rounds: int, tolerance: float, bend: float) -> np.ndarray:
    """Coefficients, intercept and scale."""
    spark, width = train.sparkSession, len(features)
    samples, path = blocks.stored_packed(train.select(*[F.col(c).cast("double") for c in (*features, label)]), "samples")

    def passed(start: np.ndarray, step: np.ndarray) -> _Sums:
        found = blocks.reduced(samples, _moments(start, step, bend), "found binary")
        if not found:
            raise ValueError("there is nothing to fit a forecaster on")
        return _Sums([np.frombuffer(r["found"]) for r in found], start + step, bend)

    nothing = np.zeros(width + 2)
    # Within a scale beyond all labels everything is a square: its least squares are where the steps begin.
    wide = passed(np.append(nothing[:-1], 1e300), nothing)
    least = wide.largest * LEAST_SCALE
    if wide.largest == 0:
        delete(spark, path)
        return np.append(nothing[:-1], 1.0)
    moments = wide.inner
    plain = solved(moments[:-1, :-1], moments[:-1, -1])
    error = moments[-1, -1] - 2 * plain @ moments[:-1, -1] + plain @ moments[:-1, :-1] @ plain
    now = passed(np.append(plain, max(np.sqrt(max(error, 0.0) / wide.rows), least)), nothing)
    loss, change = now.losses[0], MOST_CHANGE
    for _ in range(rounds):
        step = now.newton(change)
        step[-1] = max(now.at[-1] + step[-1], least) - now.at[-1]
        if not step.any():
            break
        tried = passed(now.at, step)
        best = int(np.argmin(tried.losses))
        if tried.losses[best] >= loss:
            change **= 0.5
            if change < LEAST_CHANGE:
                break
            continue
        if best:
            tried = passed(now.at, step * SHARES[best])
        gained = loss - tried.losses[0]
        now, loss = tried, tried.losses[0]
        if gained <= tolerance * abs(loss):
            break
    delete(spark, path)
    return now.at


def spark_model(spark, regressor, fitted: np.ndarray) -> LinearRegressionModel:
    """The fit as Spark's own model with the settings of ``regressor``."""
    jvm = spark._jvm
    values = spark.sparkContext._gateway.new_array(jvm.double, len(fitted) - 2)
    for i, value in enumerate(fitted[:-2]):
        values[i] = float(value)
    made = jvm.org.apache.spark.ml.regression.LinearRegressionModel
    vector = jvm.org.apache.spark.ml.linalg.DenseVector(values)
    return regressor._copyValues(LinearRegressionModel(made(regressor.uid, vector, float(fitted[-2]), float(fitted[-1]))))
