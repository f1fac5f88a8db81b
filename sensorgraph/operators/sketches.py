"""Statistics per sensor from small sketches that are kept per day and merged.

A day's readings are read once. Any span of days is then answered from one row per sensor and day: exact counts, sums and
extremes, quantiles to ``RANK_ERROR`` of the rank, distinct counts to ``DISTINCT_ERROR`` of the count (three standard
errors). ``sensor_statistics`` and ``edge_end_features`` stay the exact way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of the quantile sketch, and of the distinct sketch as a power of two.
QUANTILE_K, DISTINCT_LG_K = 200, 12
#: Error of the rank of a quantile for that size (99 % of the answers), and of a distinct count.
RANK_ERROR, DISTINCT_ERROR = 0.0133, 3 * 1.04 / 2 ** (DISTINCT_LG_K / 2)


def reading_sketches(df: DataFrame, *, sensor: str = "sensor_id", time: str = "timestamp", value: str = "speed") -> DataFrame:
    """Per sensor and ``day``: ``readings``, ``total``, ``lowest``, ``highest`` and ``quantiles``. Missing values and NaN
    count for nothing; a sensor and day without any other has no sketch."""
    known = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    return df.withColumn("__value", known).groupBy(sensor, F.to_date(time).alias("day")).agg(
        F.count("__value").alias("readings"), F.sum("__value").alias("total"), F.min("__value").alias("lowest"),
        F.max("__value").alias("highest"), F.kll_sketch_agg_double("__value", QUANTILE_K).alias("quantiles"),
    )


def merged_statistics(sketches: DataFrame, keys: Sequence[str] = ("sensor_id",), quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """``readings``, ``average_speed``, ``minimum_speed``, ``maximum_speed`` and ``quantile_<percent>`` per key."""
    merged = sketches.where("readings > 0").groupBy(*keys).agg(
        F.sum("readings").alias("readings"), F.sum("total").alias("__total"), F.min("lowest").alias("minimum_speed"),
        F.max("highest").alias("maximum_speed"), F.kll_merge_agg_double("quantiles").alias("__quantiles"),
    )
    asked = [F.kll_sketch_get_quantile_double("__quantiles", F.lit(float(q))).alias(f"quantile_{round(100 * q)}") for q in quantiles]
    return merged.select(*keys, "readings", (F.col("__total") / F.col("readings")).alias("average_speed"), "minimum_speed", "maximum_speed", *asked)


def distinct_sketches(df: DataFrame, keys: Sequence[str], of: str) -> DataFrame:
    """Per key a sketch ``distinct`` of the values of ``of``; keys are e.g. a sensor and a day."""
    return df.where(F.col(of).isNotNull()).groupBy(*keys).agg(F.hll_sketch_agg(of, DISTINCT_LG_K).alias("distinct"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``distinct_count`` per key of all sketches together."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("distinct").alias("__distinct"))
    return merged.select(*keys, F.hll_sketch_estimate("__distinct").alias("distinct_count"))
