"""Series features of new readings from a small carry table instead of the history.

Lags and rolling frames look a fixed number of rows back, and the target one row ahead. The carry of a delivery is the last
rows of every sensor: as many as the windows look back, and behind them the last row, which still waits for its target. A
new delivery needs nothing else of the past, so its cost follows its own size and the number of sensors.

    rows, carry = continue_series(todays_readings, read_table(spark, "state/carry"), cfg)
    write_gold(rows, "gold/2024-02-01")     # first the rows, then the carry that builds on them
    replace_table(carry, "state/carry")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgraph.config import SeriesConfig
from sensorgraph.operators.ordered import over_ordered
from sensorgraph.operators.series import lag_parts, order_columns, rolling_parts, target_part
from sensorgraph.operators.storage import stored

#: Of a carry: whether the row was returned already and is there for the windows of later ones only.
SETTLED = "__settled"
_NEXT, _NEW = "__has_next", "__new"


def rows_back(cfg: SeriesConfig) -> int:
    """Rows before a row that its windows read."""
    return max(*cfg.lags, *(n - 1 for n in cfg.frames))


def continue_series(
    new: DataFrame,
    carry: DataFrame | None = None,
    cfg: SeriesConfig = SeriesConfig(),
    *,
    sensor: str = "sensor_id",
    time: str = "timestamp",
    value: str = "speed",
) -> tuple[DataFrame, DataFrame]:
    """``(rows, carry)``: the rows of ``series_columns`` that have got their next row by now, and the carry for later.

    Over all deliveries together, the rows are those of one run over everything, less the last one of each sensor, which
    has no target. New readings of a sensor come after its earlier ones in the order of time and tiebreak; else it raises.
    Without a tiebreak, two deliveries must not share a time of a sensor. Columns that the carry lacks are NULL there.
    """
    order = order_columns(time, cfg.tiebreak)
    columns = list(new.columns)
    new = stored(new.withColumns({SETTLED: F.lit(False), _NEW: F.lit(True)}), "new-readings")
    if carry is None:
        together = new
    else:
        carry = stored(carry.select(*[c for c in carry.columns if c in (*columns, SETTLED)]).withColumn(_NEW, F.lit(False)), "carry")
        _require_later(new, carry, sensor, order)
        together = new.unionByName(carry, allowMissingColumns=True)
    back = rows_back(cfg)
    windows = over_ordered(
        together, [sensor], order,
        lambda w: lag_parts(w, value, cfg.lags) | rolling_parts(w, value, cfg.frames) | target_part(w, value) | {_NEXT: F.lead(F.lit(True)).over(w)},
        before=back, after=1, rows_per_task=cfg.rows_per_task,
    )
    rows = windows.where(~F.col(SETTLED) & F.col(_NEXT)).drop(SETTLED, _NEXT, _NEW)
    last = Window.partitionBy(sensor).orderBy(*[F.col(c).desc() for c in order])
    recent = together.withColumn("__from_end", F.row_number().over(last)).where(F.col("__from_end") <= back + 1)
    return rows, recent.withColumn(SETTLED, F.col("__from_end") > 1).drop("__from_end", _NEW)


def _require_later(new: DataFrame, carry: DataFrame, sensor: str, order: list[str]) -> None:
    least = new.groupBy(F.col(sensor).alias("__sensor")).agg(F.min(F.struct(*order)).alias("__first"))
    greatest = carry.groupBy(sensor).agg(F.max(F.struct(*order)).alias("__last"))
    late = greatest.join(least, F.col(sensor).eqNullSafe(F.col("__sensor"))).where(F.col("__first") <= F.col("__last"))
    example = late.select(sensor, "__first", "__last").first()
    if example is not None:
        raise ValueError(f"new readings are not later than earlier ones, e.g. of sensor {example[0]}: {example[1]} after {example[2]}")
