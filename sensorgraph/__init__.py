"""Forecasting-ready tables from sensor readings and a weighted sensor network, on Spark."""

# ruff: noqa: F401
from sensorgraph.config import GoldConfig, GraphConfig, SequenceConfig, SeriesConfig
from sensorgraph.functions.calendar import calendar_columns, cyclic_columns
from sensorgraph.functions.labels import condition_columns
from sensorgraph.functions.parsing import to_number, to_ts
from sensorgraph.operators.carry import continue_series
from sensorgraph.operators.encode import (
    assemble,
    column_moments,
    column_ranges,
    index_labels,
    label_dictionary,
    label_frequency,
    label_index,
    minmax_scale,
    one_hot,
    standard_scale,
)
from sensorgraph.operators.fitted import fit_state, index_labels_by, merge_states, minmax_scale_by, standard_scale_by
from sensorgraph.operators.forecast import (
    actual_vs_predicted,
    fit_forecaster,
    persistence,
    regression_metrics,
)
from sensorgraph.operators.graph import (
    edge_end_features,
    pagerank,
    propagate,
    restrict_to_graph,
    transitions,
    vertices,
)
from sensorgraph.operators.panel import (
    chrono_split,
    clean_features,
    dense_panel,
    edge_node_ids,
    node_ids,
    pick_target,
    sequences,
    snapshots,
    time_index,
    with_node_id,
)
from sensorgraph.operators.reshape import (
    drop_if_present,
    drop_missing,
    fill_defaults,
    fill_zero,
    flatten_arrays,
    matrix_to_edges,
    numeric_columns,
    require_columns,
    vectors_to_arrays,
    wide_to_long,
)
from sensorgraph.operators.series import (
    lag_columns,
    next_target,
    rolling_columns,
    sensor_statistics,
    series_columns,
)
from sensorgraph.operators.sketches import distinct_sketches, merged_distinct, merged_statistics, reading_sketches
from sensorgraph.plans.features import build_graph_features, build_series_features, continue_frame, gold_features
from sensorgraph.sources.inspect import profile, sample_rows
from sensorgraph.sources.rejects import read_csv_checked
from sensorgraph.sources.shards import read_shards, shard_manifest, shard_sequences, write_shards
from sensorgraph.sources.tables import (
    export_csv,
    export_parquet,
    ingest_edges,
    ingest_new_speeds,
    ingest_speeds,
    read_edges_csv,
    read_features_csv,
    read_table,
    write_gold,
)
from sensorgraph.sources.versions import merge_readings, replace_table
