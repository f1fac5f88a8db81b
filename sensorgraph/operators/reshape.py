"""Wide/long reshaping, column checks, filters and fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_COLUMNS = ("sensor_id", "timestamp", "speed")
EDGE_COLUMNS = ("source_sensor", "destination_sensor", "weight")


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def wide_to_long(
    df: DataFrame, *, sensor: str = "sensor_id", time: str = "timestamp", value: str = "speed"
) -> DataFrame:
    """One row per time and sensor column, empty cells included; long input passes through."""
    if sensor in df.columns and value in df.columns:
        return df
    readings = [F.col(f"`{c}`").cast("double").alias(c) for c in df.columns if c != time]
    return df.select(time, *readings).unpivot(
        [time], [f"`{c}`" for c in df.columns if c != time], sensor, value
    ).select(time, sensor, value)


def matrix_to_edges(df: DataFrame, keep_zero: bool = False, source: str = "source_sensor") -> DataFrame:
    """Adjacency matrix (one row per source, one column per destination) to an edge list."""
    cells = [c for c in df.columns if c != source]
    edges = df.select(source, *[F.col(f"`{c}`").cast("double").alias(c) for c in cells]).unpivot(
        [source], [f"`{c}`" for c in cells], "destination_sensor", "weight"
    )
    edges = edges.withColumn(
        "destination_sensor", F.col("destination_sensor").cast(df.schema[source].dataType)
    ).where(F.col("weight").isNotNull())
    return edges if keep_zero else edges.where(F.col("weight") != 0)


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def vectors_to_arrays(df: DataFrame) -> DataFrame:
    vectors = [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    return df.withColumns({c: vector_to_array(c) for c in vectors}) if vectors else df


def flatten_arrays(df: DataFrame, widths: Mapping[str, int] | None = None) -> DataFrame:
    """Array columns as ``name_0 .. name_k`` columns; widths are measured in one pass if not given."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not arrays:
        return df
    if widths is None:
        widths = df.agg(*[F.max(F.size(a)).alias(a) for a in arrays]).first().asDict()
    columns = []
    for name in df.columns:
        if name in arrays:
            columns += [F.get(name, F.lit(i)).alias(f"{name}_{i}") for i in range(widths[name] or 0)]
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drops rows where a column of ``subset`` is NULL or NaN."""
    return df.dropna(subset=list(subset))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL and NaN become 0."""
    return df.fillna(0, subset=list(cols)) if cols else df


def fill_defaults(df: DataFrame, mapping: Mapping[str, float]) -> DataFrame:
    return df.fillna({c: v for c, v in mapping.items() if c in df.columns})
