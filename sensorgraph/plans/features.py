"""The composed jobs: series features, graph features and the joined gold table."""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.config import GoldConfig, GraphConfig, SeriesConfig
from sensorgraph.functions.calendar import calendar_parts, cyclic_parts
from sensorgraph.functions.labels import LABEL_COLUMNS, condition_parts
from sensorgraph.operators.carry import continue_series
from sensorgraph.operators.encode import minmax_parts, one_hot
from sensorgraph.operators.graph import GRAPH_DEFAULTS, _end_features, _pagerank, collapse_edges
from sensorgraph.operators.reshape import (
    EDGE_COLUMNS,
    SERIES_COLUMNS,
    drop_if_present,
    drop_missing,
    fill_defaults,
    fill_zero,
    numeric_columns,
    require_columns,
    vectors_to_arrays,
)
from sensorgraph.operators.series import TARGET, series_columns, window_column_names
from sensorgraph.operators.storage import stored

# The large columns that gold leaves out.
LARGE_COLUMNS = ("features", "scaled_features", "numeric_features")


def scaled_inputs(df: DataFrame, tiebreak: str | None = None) -> list[str]:
    """The numeric columns that are filled and scaled: all but keys, speed, target and indices."""
    skip = {*SERIES_COLUMNS, TARGET, tiebreak, *[f"{c}_index" for c in LABEL_COLUMNS]}
    return numeric_columns(df, skip)


def series_frame(df: DataFrame, cfg: SeriesConfig = SeriesConfig()) -> DataFrame:
    """Calendar, lag, rolling, label and cyclic columns of all rows that have a target."""
    require_columns(df, SERIES_COLUMNS)
    return frame_columns(drop_missing(series_columns(df, cfg), [TARGET]), df.columns, cfg)


def frame_columns(rows: DataFrame, given: list[str], cfg: SeriesConfig = SeriesConfig()) -> DataFrame:
    """Calendar, label and cyclic columns beside the window columns that ``rows`` has; ``given`` are its own columns."""
    calendar, cyclic = calendar_parts("timestamp"), cyclic_parts("timestamp")
    labels = condition_parts(free_flow=cfg.free_flow, moderate=cfg.moderate)
    made = [*calendar, *window_column_names(cfg), *labels, *cyclic, TARGET]
    return rows.withColumns(calendar | labels | cyclic).select(*[c for c in given if c not in made], *made)


def continue_frame(new: DataFrame, carry: DataFrame | None = None, cfg: SeriesConfig = SeriesConfig()) -> tuple[DataFrame, DataFrame]:
    """``series_frame`` of a further delivery and the carry for the next one; see ``continue_series``."""
    rows, carry = continue_series(new, carry, cfg)
    return frame_columns(drop_missing(rows, [TARGET]), new.columns, cfg), carry


def build_series_features(
    df: DataFrame,
    cfg: SeriesConfig = SeriesConfig(),
    vectors: bool = True,
    fit_df: DataFrame | None = None,
) -> DataFrame:
    """The whole per-sensor feature table.

    ``fit_df`` (a ``series_frame``) fits label indices and ranges on other rows than those transformed,
    e.g. on the training part. ``vectors=False`` leaves out the scaled and assembled vectors, and with
    them the pass that fits the ranges.
    """
    frame = series_frame(df, cfg)
    if vectors and fit_df is None:
        frame = stored(frame, "series-frame")  # the ranges need a pass over all columns before the output pass
    numbers = scaled_inputs(frame, cfg.tiebreak)
    filled = fill_zero(frame, numbers)
    fit_on = filled if fit_df is None else fill_zero(fit_df, numbers)
    labels, ranges = _fit(fit_on, numbers if vectors else [])
    indexed = filled
    for c, known in labels.items():
        indexed = StringIndexerModel.from_labels(known, c, f"{c}_index", "keep").transform(indexed)
    encoded = one_hot(indexed, LABEL_COLUMNS)
    if not vectors:
        return encoded
    scaled = minmax_parts(ranges)
    together = encoded.withColumns(
        {
            "numeric_features": array_to_vector(F.array(*[F.col(c).cast("double") for c in numbers])),
            "scaled_features": array_to_vector(F.array(*[scaled[c] for c in numbers])),
        }
    )
    parts = ["scaled_features", *[f"{c}_vector" for c in LABEL_COLUMNS]]
    return VectorAssembler(inputCols=parts, outputCol="features").transform(together)


def _fit(frame: DataFrame, numbers: list[str]):
    """Labels by falling frequency and column ranges, from one pass over ``frame``.

    Rows are combined per combination of labels, of which there are at most 4 * 3 * 3 * 3.
    """
    groups = frame.groupBy(*LABEL_COLUMNS).agg(
        F.count("*").alias("rows"),
        *[F.min(c).cast("double").alias(f"{c}_min") for c in numbers],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in numbers],
    ).collect()
    labels = {}
    for c in LABEL_COLUMNS:
        counts = Counter()
        for group in groups:
            counts[group[c]] += group["rows"]
        labels[c] = sorted(counts, key=lambda label: (-counts[label], label))
    ranges = {
        c: (
            min((g[f"{c}_min"] for g in groups), default=None),
            max((g[f"{c}_max"] for g in groups), default=None),
        )
        for c in numbers
    }
    return labels, ranges


def build_graph_features(edges: DataFrame, cfg: GraphConfig = GraphConfig()) -> DataFrame:
    """Degrees, weights, neighbours and PageRank per sensor."""
    require_columns(edges, EDGE_COLUMNS)
    pairs = stored(collapse_edges(edges), "edge-pairs")
    ends = _end_features(pairs, "sensor_id")
    ranks = _pagerank(
        pairs, cfg.iterations, cfg.reset, cfg.store_every, "sensor_id", cfg.broadcast_rows,
        cfg.links_per_slot,
    )
    return fill_defaults(ends.join(ranks, "sensor_id", "left"), GRAPH_DEFAULTS)


def gold_features(df: DataFrame, edges: DataFrame, cfg: GoldConfig = GoldConfig()) -> DataFrame:
    """Series features joined with the graph features of their sensor, vectors as arrays."""
    series = build_series_features(df, cfg.series, vectors=cfg.series.keep_scaled)
    graph = stored(build_graph_features(edges, cfg.graph), "graph-features")
    graph = graph.withColumn("sensor_id", F.col("sensor_id").cast(df.schema["sensor_id"].dataType))
    joined = fill_zero(series.join(graph, "sensor_id", "left"), list(GRAPH_DEFAULTS))
    drop = LARGE_COLUMNS if not cfg.series.keep_scaled else LARGE_COLUMNS[2:]
    tiebreak = [cfg.series.tiebreak] if cfg.series.tiebreak else []
    return drop_if_present(vectors_to_arrays(joined), [*drop, *tiebreak])
