"""Per-sensor lags, rolling statistics, targets and summary statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sensorgraph.config import ROWS_PER_TASK, SeriesConfig
from sensorgraph.operators.ordered import over_ordered
from sensorgraph.operators.reshape import drop_missing

TARGET = "target_speed"
ROLLING = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}


def lag_parts(window: WindowSpec, value: str, lags) -> dict[str, Column]:
    parts = {f"lag_{k}": F.lag(value, k).over(window) for k in lags}
    return parts | {"speed_change": F.col(value) - F.lag(value, 1).over(window)}


def rolling_parts(window: WindowSpec, value: str, sizes) -> dict[str, Column]:
    """Frames end at the current row and are shorter at the start of a series."""
    return {
        f"rolling_{name}_{n}": statistic(value).over(window.rowsBetween(1 - n, 0))
        for n in sizes
        for name, statistic in ROLLING.items()
    }


def target_part(window: WindowSpec, value: str, steps: int = 1) -> dict[str, Column]:
    return {TARGET: F.lead(value, steps).over(window)}


def window_column_names(cfg: SeriesConfig) -> list[str]:
    """Names of the lag and rolling columns of ``series_columns``."""
    lags = [f"lag_{k}" for k in cfg.lags]
    return [*lags, "speed_change", *[f"rolling_{s}_{n}" for n in cfg.frames for s in ROLLING]]


def order_columns(time: str, tiebreak: str | None) -> list[str]:
    """What the rows of a sensor are ordered by."""
    return [time] if tiebreak is None else [time, tiebreak]


def lag_columns(
    df: DataFrame,
    lags=(1, 2, 3, 6, 12),
    tiebreak: str | None = None,
    *,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    value: str = "speed",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Lags count rows, not minutes. Adds ``speed_change`` next to the lags."""
    return over_ordered(
        df, [sensor], order_columns(time, tiebreak), lambda w: lag_parts(w, value, lags),
        before=max(lags), rows_per_task=rows_per_task,
    )


def rolling_columns(
    df: DataFrame,
    sizes=(3, 6, 12),
    tiebreak: str | None = None,
    *,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    value: str = "speed",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    return over_ordered(
        df, [sensor], order_columns(time, tiebreak), lambda w: rolling_parts(w, value, sizes),
        before=max(sizes) - 1, rows_per_task=rows_per_task,
    )


def next_target(
    df: DataFrame,
    steps: int = 1,
    tiebreak: str | None = None,
    *,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    value: str = "speed",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """The value ``steps`` rows ahead; rows without one are dropped."""
    with_target = over_ordered(
        df, [sensor], order_columns(time, tiebreak), lambda w: target_part(w, value, steps),
        after=steps, rows_per_task=rows_per_task,
    )
    return drop_missing(with_target, [TARGET])


def series_columns(
    df: DataFrame,
    cfg: SeriesConfig = SeriesConfig(),
    *,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    value: str = "speed",
) -> DataFrame:
    """Lags, rolling statistics and the next-row target from one shuffle and one sort.

    Rows without a target are still here, because the lags of later rows need them.
    """
    return over_ordered(
        df,
        [sensor],
        order_columns(time, cfg.tiebreak),
        lambda w: lag_parts(w, value, cfg.lags)
        | rolling_parts(w, value, cfg.frames)
        | target_part(w, value),
        before=max(*cfg.lags, *(n - 1 for n in cfg.frames)),
        after=1,
        rows_per_task=cfg.rows_per_task,
    )


def sensor_statistics(
    df: DataFrame, *, sensor: str = "sensor_id", value: str = "speed"
) -> DataFrame:
    return df.groupBy(sensor).agg(
        F.avg(value).alias("average_speed"),
        F.max(value).alias("maximum_speed"),
        F.min(value).alias("minimum_speed"),
        F.percentile_approx(value, 0.5).alias("median_speed"),
        F.stddev_samp(value).alias("standard_deviation"),
        F.var_samp(value).alias("variance"),
    )
