"""Window functions over ordered series, also when one key holds a large share of all rows.

Lags, row frames and leads need only a few neighbouring rows. A series that is too long for one task is
therefore cut along its time axis into pieces of about ``rows_per_task`` rows; the few buckets next to a
cut are handed to both pieces, and each piece returns only its own rows. The result equals the uncut
window.

Buckets follow the rows, not the calendar: each long series is divided within its own range, and every bucket
that still holds too many rows within the range of its own rows, until it is small or holds one instant. An
outlying time, a burst or many rows within a second cost a further round and no balance. Infinite and undefined values of
a number axis stand in end buckets of their own.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgraph.config import MOST_TASKS, ROWS_PER_TASK
from sensorgraph.operators.storage import stored

BUCKETS_PER_PIECE = 16
_BUCKET, _PIECE, _OWN, _AXIS = "__bucket", "__piece", "__own", "__axis"


def over_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Adds ``columns(window)`` where the window runs over ``order`` within ``keys``.

    The columns may look at most ``before`` rows back and ``after`` rows ahead. ``order[0]`` is a number,
    date or timestamp. Rows of one key with equal ``order[0]`` stay in one piece. Rows and range of every
    series are read first; ``rows_per_task=None`` skips that for series whose length is bounded by construction.
    """
    plain = Window.partitionBy(*keys).orderBy(*order)
    if rows_per_task is None:
        return df.withColumns(columns(plain))
    axis = _axis(df, order[0])
    series = stored(
        df.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(axis).alias("low"), F.max(axis).alias("high")),
        "series",
    )
    longest, total = series.agg(F.max("rows"), F.sum("rows")).first()
    longest, total = longest or 0, total or 0
    if longest <= rows_per_task:
        return _placed(df, keys, total, rows_per_task).withColumns(columns(plain))
    cut = _cut(df, keys, order[0], before, after, rows_per_task, series)
    pieces = _placed(cut, [*keys, _PIECE], total, rows_per_task)
    window = Window.partitionBy(*keys, _PIECE).orderBy(*order)
    return pieces.withColumns(columns(window)).where(_OWN).drop(_BUCKET, _PIECE, _OWN)


def _placed(df: DataFrame, keys: Sequence[str], total: int, rows_per_task: int) -> DataFrame:
    """Places rows by ``keys`` in more partitions than the session's setting where the counted rows need
    them; the window then uses this placement instead of its own."""
    needed = -(-total // max(rows_per_task, ROWS_PER_TASK))
    if needed > MOST_TASKS:
        warnings.warn(f"{total} rows in {needed} tasks; raise rows_per_task if the driver cannot hold them", stacklevel=3)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(needed, *keys) if needed > usual else df


def _cut(df, keys, axis_name, before, after, rows_per_task, series) -> DataFrame:
    axis, most = _axis(df, axis_name), max(1, rows_per_task // BUCKETS_PER_PIECE)
    # Only the long series are divided: at most rows / rows_per_task of them exist.
    long_series = series.where(F.col("rows") > rows_per_task)
    endless = ~(F.abs("low") < float("inf")) | ~(F.abs("high") < float("inf"))
    odd = not long_series.where(endless).isEmpty()
    root = _root(axis) if odd else F.array(F.lit(0).cast("double"))
    facts = df.withColumns({_AXIS: axis, _BUCKET: root})
    rows = _null_safe_join(facts.select(*keys, _AXIS, _BUCKET), long_series.select(*keys), keys, "left_semi")
    sizes = _bucket_sizes(rows, keys) if odd else long_series.select(*keys, root.alias(_BUCKET), "rows", "low", "high")
    while True:
        divided = sizes.where((F.col("rows") > most) & (F.col("low") < F.col("high")))
        parts = F.ceil(F.col("rows") / most) * 2
        width = F.col("high") / parts - F.col("low") / parts  # the difference itself may be too large for a double
        divided = divided.select(*keys, _BUCKET, "low", width.alias("width")).where((F.col("width") > 0) & (F.col("low").isNotNull()))
        divided = stored(divided, "divided-buckets")
        if divided.isEmpty():
            break
        facts = _divided(facts, divided, keys)
        rows = stored(_divided(rows, divided, keys), "long-series-rows")
        sizes = _bucket_sizes(rows, keys)
    placement = stored(_placement(sizes.drop("low", "high"), keys, before, after, rows_per_task), "series-pieces")
    placed = _null_safe_join(facts.drop(_AXIS), placement, [*keys, _BUCKET], "left")
    return placed.withColumns(
        {
            _PIECE: F.explode(F.coalesce("pieces", F.array(F.lit(0).cast("long")))),
            "own_piece": F.coalesce("own_piece", F.lit(0).cast("long")),
        }
    ).withColumn(_OWN, F.col(_PIECE) == F.col("own_piece")).drop("pieces", "own_piece")


def _root(axis: Column) -> Column:
    """The first bucket of a series; values that no range can hold stand in buckets of their own, which are not divided."""
    infinite = F.abs(axis) == float("inf")
    end = F.when(axis.isNull(), -2.0).when(F.isnan(axis), 2.0).when(infinite, F.signum(axis)).otherwise(0.0)
    return F.array(end)


def _bucket_sizes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    ends = F.count("*").alias("rows"), F.min(_AXIS).alias("low"), F.max(_AXIS).alias("high")
    return stored(rows.groupBy(*keys, _BUCKET).agg(*ends), "bucket-sizes")


def _divided(rows: DataFrame, divided: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A bucket is the path of its divisions, which sorts as its rows do; missing times come first."""
    step = F.coalesce(F.floor((F.col(_AXIS) - F.col("low")) / F.col("width")).cast("double"), F.lit(-1.0))
    path = F.when(F.col("width").isNotNull(), F.concat(_BUCKET, F.array(step))).otherwise(F.col(_BUCKET))
    joined = _null_safe_join(rows, divided, [*keys, _BUCKET], "left")
    return joined.withColumn(_BUCKET, path).drop("low", "width")


def _placement(sizes, keys, before, after, rows_per_task) -> DataFrame:
    """Per bucket of a long series: the piece it belongs to and all pieces that read it."""
    window = Window.partitionBy(*keys).orderBy(_BUCKET)
    bounds = (
        sizes.withColumn("stop", F.sum("rows").over(window))
        .withColumn("start", F.col("stop") - F.col("rows"))
        .withColumn("piece", F.floor(F.col("start") / F.lit(rows_per_task)).cast("long"))
    )
    step = F.struct("piece", "start", "stop")
    readers = [F.array("piece")]
    if before:
        following = F.collect_list(step).over(window.rowsBetween(1, before))
        close = F.filter(following, lambda s: s["start"] < F.col("stop") + before)
        readers.append(F.transform(close, lambda s: s["piece"]))
    if after:
        preceding = F.collect_list(step).over(window.rowsBetween(-after, -1))
        close = F.filter(preceding, lambda s: s["stop"] > F.col("start") - after)
        readers.append(F.transform(close, lambda s: s["piece"]))
    return bounds.select(
        *keys,
        _BUCKET,
        F.col("piece").alias("own_piece"),
        F.array_distinct(F.concat(*readers)).alias("pieces"),
    )


def _axis(df: DataFrame, name: str) -> Column:
    """The time column as a number that never decreases along its order."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # Calendar fields, so that no clock change of the session zone can reorder local times.
        days = F.date_diff(F.to_date(column), F.lit("1970-01-01").cast("date")).cast("double")
        minutes = (F.hour(column) * 60 + F.minute(column)).cast("double")
        seconds = F.extract(F.lit("SECOND"), column).cast("double")  # with its fraction
        return (days * 1440 + minutes) * 60e6 + F.round(seconds * 1e6)
    if isinstance(kind, T.DateType):
        return F.date_diff(column, F.lit("1970-01-01").cast("date")).cast("double")
    return column.cast("double")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    )
    joined = left.join(renamed, same, how)
    return joined.drop(*[f"__r_{k}" for k in keys])
