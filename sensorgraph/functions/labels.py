"""Condition labels of a speed reading and its change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL_COLUMNS = ("time_of_day", "congestion_level", "speed_category", "traffic_trend")


def condition_parts(
    value: str = "speed",
    change: str = "speed_change",
    previous: str = "lag_1",
    free_flow: float = 60,
    moderate: float = 40,
) -> dict[str, Column]:
    """A missing speed falls through to the last label of each chain, as in the reference."""
    speed, delta, lag = F.col(value), F.col(change), F.col(previous)
    return {
        "congestion_level": F.when(speed > free_flow, "Free Flow")
        .when(speed >= moderate, "Moderate")
        .otherwise("Congested"),
        "speed_category": F.when(speed < moderate, "Low")
        .when(speed <= free_flow, "Medium")
        .otherwise("High"),
        "traffic_trend": F.when(delta > 0, "Increasing")
        .when(delta < 0, "Decreasing")
        .otherwise("Stable"),
        "percent_change": F.when(lag != 0, (speed - lag) / lag * 100),
    }


def condition_columns(
    df: DataFrame, value: str = "speed", free_flow: float = 60, moderate: float = 40
) -> DataFrame:
    """Needs ``lag_1`` and ``speed_change`` (see ``lag_columns``)."""
    return df.withColumns(condition_parts(value, free_flow=free_flow, moderate=moderate))
