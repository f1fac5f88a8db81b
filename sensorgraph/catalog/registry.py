"""Named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


# Added before rounding on both sides. It moves exact ties (a mean of cents over 64 rows) off the edge, where
# the two engines round differently, and turns -0.0 into 0.0.
NUDGE = 1e-9


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """All double columns rounded, so that the order of additions does not show."""
    return df.select(
        *[
            F.round(F.col(f.name) + F.lit(NUDGE), special.get(f.name, digits)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r(expression: str, alias: str, digits: int = 6) -> str:
    """SQL rounding to match ``rounded``."""
    return f"round({expression} + {NUDGE:.9f}::double, {digits}) as {alias}"
