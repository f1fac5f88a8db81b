"""Fitted state of scalers and label indices as a table that is stored, merged and applied again.

A state has one row per numeric column (values, mean, squared deviations from it, least and greatest value) and one per
label of a label column (its rows). States of separate parts of the data merge into the state of all of it, so a day's
readings are read once; transforms read the state only, whatever the size of the data it was fitted on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.operators.encode import dictionary_of, index_labels, minmax_parts, standard_parts
from sensorgraph.operators.encode import label_frequency
from sensorgraph.operators.storage import stored

STATE = "kind string, column string, label string, count long, mean double, deviations double, low double, high double"
NUMBER, LABEL = "number", "label"


def fit_state(df: DataFrame, numbers: Sequence[str] = (), labels: Sequence[str] = ()) -> DataFrame:
    """The state of ``df``: one pass for the numbers, one for the labels. NULLs count for nothing."""
    parts = []
    if numbers:
        one = df.agg(*[
            F.struct(
                F.count(c).alias("count"), F.avg(c).cast("double").alias("mean"), (F.var_pop(c) * F.count(c)).alias("deviations"),
                F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"),
            ).alias(c)
            for c in numbers
        ])
        each = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("s")) for c in numbers])))
        parts.append(each.select(F.lit(NUMBER).alias("kind"), "column", F.lit(None).cast("string").alias("label"), "s.*"))
    if labels:
        counted = label_frequency(df, labels)
        none = [F.lit(None).cast("double").alias(c) for c in ("mean", "deviations", "low", "high")]
        parts.append(counted.select(F.lit(LABEL).alias("kind"), "column", "label", "count", *none))
    if not parts:
        return df.sparkSession.createDataFrame([], STATE)
    return reduce(DataFrame.unionByName, parts)


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of all. Means and deviations are combined pair by pair, which keeps their digits where sums of squares
    would not; a group has as many rows as there are states."""
    together = reduce(DataFrame.unionByName, states)
    part = F.struct(F.col("count").cast("double").alias("n"), F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("deviations", F.lit(0.0)).alias("d"))

    def combined(a, b):
        n = a["n"] + b["n"]
        share = F.when(n > 0, b["n"] / F.when(n > 0, n)).otherwise(F.lit(0.0))
        apart = b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + apart * share).alias("mean"), (a["d"] + b["d"] + apart * apart * a["n"] * share).alias("d"))

    nothing = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("d"))
    numbers = together.where(F.col("kind") == NUMBER).groupBy("kind", "column", "label").agg(
        F.sum("count").alias("count"), F.aggregate(F.collect_list(part), nothing, combined).alias("s"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    seen = F.col("count") > 0
    numbers = numbers.select("kind", "column", "label", "count", F.when(seen, F.col("s.mean")).alias("mean"), F.when(seen, F.col("s.d")).alias("deviations"), "low", "high")
    labels = together.where(F.col("kind") == LABEL).groupBy("kind", "column", "label").agg(F.sum("count").alias("count"))
    return numbers.unionByName(labels, allowMissingColumns=True)


def _numbers(state: DataFrame, cols: Sequence[str]) -> dict:
    """The rows of ``cols``, one each."""
    wanted = state.where((F.col("kind") == NUMBER) & F.col("column").isin(*cols))
    found = {row["column"]: row for row in wanted.collect()}
    missing = [c for c in cols if c not in found]
    if missing:
        raise ValueError(f"the state was not fitted on {', '.join(missing)}")
    return found


def standard_scale_by(df: DataFrame, state: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero mean and unit population variance of the fitted data; columns that were constant there become 0."""
    fitted = {c: (r["mean"], (r["deviations"] / r["count"]) ** 0.5 if r["count"] else None, r["low"] == r["high"]) for c, r in _numbers(state, cols).items()}
    return df.withColumns(standard_parts(fitted))


def minmax_scale_by(df: DataFrame, state: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The fitted range to [0, 1]; values outside it go beyond, columns that were constant there become 0.5."""
    return df.withColumns(minmax_parts({c: (r["low"], r["high"]) for c, r in _numbers(state, cols).items()}))


def index_labels_by(df: DataFrame, state: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>_index`` by the fitted frequencies; see ``index_labels``."""
    wanted = state.where((F.col("kind") == LABEL) & F.col("column").isin(*cols))
    return index_labels(df, dictionary_of(stored(wanted.select("column", "label", "count"), "label-frequency")), cols)
