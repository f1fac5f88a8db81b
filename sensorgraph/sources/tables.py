"""Reading, ingesting and writing the tables of the job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgraph.operators.reshape import EDGE_COLUMNS, flatten_arrays, require_columns, wide_to_long
from sensorgraph.operators.storage import stored
from sensorgraph.sources.versions import merge_readings, read_manifest, read_versioned, replace_table

# Spark's own CSV formats stop at milliseconds.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("source_sensor", T.LongType()),
        T.StructField("destination_sensor", T.LongType()),
        T.StructField("weight", T.DoubleType()),
    ]
)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A folder of files, or what its manifest names if it has versions (see ``replace_table``)."""
    manifest = None if fmt == "delta" else read_manifest(spark, path)
    if manifest is not None:
        return read_versioned(spark, path, manifest)
    return spark.read.format(fmt).load(path)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    """The schema's columns picked by their names in the header, whatever their order and whatever else is there."""
    text = spark.read.option("header", True).option("mode", mode)
    require_columns(names := text.csv(path), schema.fieldNames())
    kinds = {f.name: f.dataType for f in schema}
    whole = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in names.columns])
    return text.options(**CSV_TIMES).schema(whole).csv(path).select(*schema.fieldNames())


def read_edges_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """``source_sensor, destination_sensor, weight`` by header name; further columns are left out.

    ``mode`` says what happens to values that do not parse: NULL, or ``FAILFAST`` to raise.
    """
    return _read_csv(spark, path, EDGE_SCHEMA, mode)


def read_features_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Give a schema for large files: inferring one reads the text twice. Its columns are picked by name."""
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).option("mode", mode).csv(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return _read_csv(spark, path, schema, mode)


def write_gold(
    df: DataFrame,
    path: str,
    partitions: int | None = None,
    fmt: str = "parquet",
    rows_per_file: int = 0,
) -> None:
    """Replaces the table and its schema; readers use ``read_table``.

    The rows are written as a new version first (``replace_table``), so a failed job leaves the old table; Delta keeps its
    own versions. By default the partitions are written as they come: after the windows they are already sized by
    adaptive execution, and wide rows are not shuffled again. ``partitions`` forces a fixed number of output
    tasks (the reference uses 50); ``rows_per_file`` splits large output files.
    """
    if partitions is not None:
        df = df.repartition(partitions)
    if fmt == "delta":
        writer = df.write.format(fmt).mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        writer.option("overwriteSchema", "true").save(path)
    else:
        replace_table(df, path, fmt, maxRecordsPerFile=str(rows_per_file))


# Fixed value: what other Parquet writers call lz4 is the raw variant.
CODECS = {"lz4": "lz4_raw"}


def export_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Codecs of the session's Parquet; ``lz4`` is the raw variant, brotli needs its codec jar."""
    codec = CODECS.get(compression, compression)
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def export_csv(df: DataFrame, path: str, widths: Mapping[str, int] | None = None) -> None:
    """CSV has no arrays: each becomes one column per element. Times keep their microseconds.

    ``widths`` names the length of every array column. Without it the input is written once to be measured.
    """
    arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    if arrays and widths is None:
        df = stored(df, "csv-input")
    writer = flatten_arrays(df, widths).write.mode("overwrite").option("header", True)
    writer.options(**CSV_TIMES).csv(path)


def _speeds(spark: SparkSession, src: str, time_col: str, fmt: str, id_type: str) -> DataFrame:
    raw = read_table(spark, src, fmt)
    require_columns(raw, [time_col])
    speeds = wide_to_long(raw.withColumnRenamed(time_col, "timestamp"))
    require_columns(speeds, ["sensor_id", "speed"])
    return speeds.withColumns({"sensor_id": F.col("sensor_id").cast(id_type), "speed": F.col("speed").cast("double")})


def ingest_speeds(
    spark: SparkSession,
    src: str,
    dst: str,
    time_col: str,
    fmt: str = "parquet",
    id_type: str = "long",
) -> None:
    """Raw wide or long speeds to silver: ``sensor_id``, ``timestamp``, ``speed`` double. Replaces the whole table."""
    _speeds(spark, src, time_col, fmt, id_type).write.format(fmt).mode("overwrite").save(dst)


def ingest_new_speeds(
    spark: SparkSession,
    src: str,
    dst: str,
    time_col: str,
    fmt: str = "parquet",
    id_type: str = "long",
    order: str | None = None,
) -> list[str]:
    """Like ``ingest_speeds``, but merges a further delivery by sensor and time into the silver table at ``dst``; only the
    dates it has readings for are written anew, and they are returned (see ``merge_readings``)."""
    return merge_readings(_speeds(spark, src, time_col, fmt, id_type), dst, order=order, fmt=fmt)


def ingest_edges(spark: SparkSession, src: str, dst: str, fmt: str = "parquet") -> None:
    """Raw edge list to silver: ids long, weight double."""
    raw = read_table(spark, src, fmt)
    require_columns(raw, EDGE_COLUMNS)
    edges = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EDGE_SCHEMA])
    edges.write.format(fmt).mode("overwrite").save(dst)
