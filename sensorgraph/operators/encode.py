"""Label indexing, one-hot vectors, scaling and vector assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgraph.config import BROADCAST_ROWS
from sensorgraph.operators.panel import dense_index
from sensorgraph.operators.reshape import fill_zero, numeric_columns
from sensorgraph.operators.storage import fits_broadcast, stored


def label_frequency(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per label of every column, as ``(column, label, count)``."""
    labels = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "label")
    return labels.where(F.col("label").isNotNull()).groupBy("column", "label").count()


#: Distinct labels of all columns up to which a fitted index is held by the driver.
MOST_LABELS = 100_000
#: Labels of a column that are joined by broadcast, as the most frequent ones, where the whole list is not.
HOT_LABELS = 50_000


def label_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, label, count, index)``: 0 is the most frequent label of its column, ties in alphabetical order.

    A stored table of any size: it can be kept, and ``index_labels`` applies it to other frames.
    """
    return dictionary_of(stored(label_frequency(df, cols), "label-frequency"))


def dictionary_of(frequency: DataFrame) -> DataFrame:
    """The dictionary of counted labels."""
    ranked = dense_index(frequency.withColumn("__rare", -F.col("count")), ["column", "__rare", "label"], "__place")
    ranked = stored(ranked.drop("__rare"), "label-places")
    # One row per column.
    starts = ranked.groupBy(F.col("column").alias("__column")).agg(F.min("__place").alias("__start"))
    numbered = ranked.join(F.broadcast(starts), F.col("column") == F.col("__column"))
    return stored(numbered.select("column", "label", "count", (F.col("__place") - F.col("__start")).alias("index")), "label-dictionary")


def index_labels(
    df: DataFrame, dictionary: DataFrame, cols: Sequence[str], broadcast_rows: int = BROADCAST_ROWS, hot_labels: int = HOT_LABELS
) -> DataFrame:
    """``<col>_index`` (double) by a dictionary; missing and unseen labels get one extra last index.

    A column's labels are broadcast if they are checked to be few. Otherwise the ``hot_labels`` most frequent ones are (if
    texts of any length allow it), and the rest is joined by shuffle, where rows that need no more label are spread evenly.
    """
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for c in cols:
        own = dictionary.where(F.col("column") == c).select(F.col("label").alias("__label"), F.col("index").cast("double").alias("__index"))
        unseen = own.count()
        found = F.col("__index")
        label = F.col(c).cast("string")
        if fits_broadcast(own, broadcast_rows):
            df = df.join(F.broadcast(own), label == F.col("__label"), "left")
        else:
            hot = own.where(F.col("__index") < hot_labels).withColumnsRenamed({"__label": "__hot_label", "__index": "__hot"})
            small = fits_broadcast(hot, max(hot_labels, 1))
            df = df.join(F.broadcast(hot) if small else hot.limit(0), label == F.col("__hot_label"), "left")
            rest = own.where(F.col("__index") >= hot_labels) if small else own
            cold = F.col("__hot").isNull() & label.isNotNull()
            # Rows without a label to look up would all meet in the task of the missing key.
            df = df.withColumns({"__cold": F.when(cold, label), "__slot": F.when(cold, 0).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(slots)).cast("int"))})
            df = df.join(rest.withColumn("__rest_slot", F.lit(0)), (F.col("__cold") == F.col("__label")) & (F.col("__slot") == F.col("__rest_slot")), "left")
            found = F.coalesce("__hot", "__index")
        # Its number of values tells one_hot the width, also where the last index does not occur.
        index = F.coalesce(found, F.lit(float(unseen))).alias(f"{c}_index", metadata={"ml_attr": {"type": "nominal", "num_vals": unseen + 1}})
        helpers = {"__label", "__index", "__hot", "__hot_label", "__cold", "__slot", "__rest_slot"}
        df = df.select(*[F.col(f"`{k}`") for k in df.columns if k not in helpers and k != f"{c}_index"], index)
    return df


def label_index(
    df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None, most_labels: int = MOST_LABELS
) -> DataFrame:
    """``<col>_index``: 0 is the most frequent label, ties in alphabetical order.

    Missing and unseen labels get one extra last index. Up to ``most_labels`` distinct labels the fitted lists go through
    the driver into the plan; beyond them a ``label_dictionary`` is joined. Either way labels are counted once.
    """
    frequency = stored(label_frequency(df if fit_df is None else fit_df, cols), "label-frequency")
    held = frequency.limit(most_labels + 1).collect()
    if len(held) > most_labels:
        return index_labels(df, dictionary_of(frequency), cols)
    for c in cols:
        labels = sorted((-row["count"], row["label"]) for row in held if row["column"] == c)
        if labels:
            model = StringIndexerModel.from_labels([label for _, label in labels], c, f"{c}_index", "keep")
            df = model.transform(df)
        else:  # no label was seen: every row has the extra index
            df = df.withColumn(f"{c}_index", F.lit(0.0).alias("i", metadata={"ml_attr": {"type": "nominal", "num_vals": 1}}))
    return df


def one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>_vector`` from ``<col>_index``; missing and unseen labels are all zeros."""
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_vector" for c in cols]
    )
    return encoder.fit(df).transform(df)


def column_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum and maximum of every column, in one row."""
    return df.agg(
        *[F.min(c).cast("double").alias(f"{c}_min") for c in cols],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in cols],
    )


def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation of every column, in one row."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in cols],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in cols],
    )


def minmax_parts(ranges: Mapping[str, tuple[float | None, float | None]]) -> dict[str, Column]:
    """Expressions that map each column to [0, 1] by its range; constants become 0.5."""
    parts = {}
    for c, (low, high) in ranges.items():
        if low is None:
            parts[c] = F.lit(None).cast("double")
        elif low == high:
            parts[c] = F.when(F.col(c).isNotNull(), F.lit(0.5))
        else:
            parts[c] = (F.col(c) - F.lit(low)) / F.lit(high - low)
    return parts


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    fitted = column_ranges(df if fit_df is None else fit_df, cols).first()
    return df.withColumns(minmax_parts({c: (fitted[f"{c}_min"], fitted[f"{c}_max"]) for c in cols}))


def standard_scale(df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population variance; constant columns become 0."""
    fit_df = df if fit_df is None else fit_df
    fitted = fit_df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in cols],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in cols],
        *[(F.min(c) == F.max(c)).alias(f"{c}_constant") for c in cols],
    ).first()
    return df.withColumns(standard_parts({c: (fitted[f"{c}_mean"], fitted[f"{c}_std"], fitted[f"{c}_constant"]) for c in cols}))


def standard_parts(fitted: Mapping[str, tuple[float | None, float | None, bool | None]]) -> dict[str, Column]:
    """Expressions by (mean, standard deviation, whether constant); constants become 0."""
    parts = {}
    for c, (mean, std, constant) in fitted.items():
        if mean is None:
            parts[c] = F.lit(None).cast("double")
        elif constant:
            parts[c] = F.when(F.col(c).isNotNull(), F.col(c) * 0.0)
        else:
            parts[c] = (F.col(c) - F.lit(mean)) / F.lit(std)
    return parts


def assemble(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """One vector of all columns (numbers or vectors); missing numbers count as 0."""
    numbers = [c for c in numeric_columns(df) if c in cols]
    assembler = VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")
    return assembler.transform(fill_zero(df, numbers))
