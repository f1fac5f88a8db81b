"""Table profile and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-null values and rows of the table, in one pass."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count("*").alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    described = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(f"`{c}`").alias("non_null")
            )
            for c in df.columns
        ]
    )
    return counts.select("__rows", F.inline(described)).select(
        "column", "type", "non_null", F.col("__rows").alias("rows")
    )


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)
