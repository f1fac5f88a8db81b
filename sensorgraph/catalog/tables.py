"""Queries of the sources, sinks and reshaping operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sensorgraph.catalog import fixtures as fx
from sensorgraph.catalog.registry import query, r, rounded
from sensorgraph.catalog.sqltext import CALENDAR, columns, label_flags, label_joins, label_views
from sensorgraph.functions.calendar import calendar_columns
from sensorgraph.functions.parsing import to_number, to_ts
from sensorgraph.operators import reshape
from sensorgraph.operators.encode import label_index, one_hot
from sensorgraph.operators.graph import restrict_to_graph
from sensorgraph.operators.storage import scratch_path
from sensorgraph.sources import inspect, rejects, tables

CODECS = ("snappy", "gzip", "lz4", "zstd", "none")
WIDE_IDS = {t: str(i) for i, t in enumerate(fx.EVENT_TYPES)}


@query("s01_read_table", fx.with_views("select * from speed_long"))
def s01(spark, sf):
    events = tables.read_table(spark, f"{sf}/events.parquet")
    return events.select(
        F.col("user_id").alias("sensor_id"), F.col("ts").alias("timestamp"),
        F.col("value").alias("speed"), "event_id",
    )


@query("s02_edges_csv", fx.with_views("select * from sensor_edges"))
def s02(spark, sf):
    path = scratch_path(spark, "edges-csv")
    tables.export_csv(fx.sensor_edges(spark, sf), path)
    return tables.read_edges_csv(spark, path)


@query("s02_edges_csv_by_name", fx.with_views("select * from sensor_edges"))
def s02_by_name(spark, sf):
    """Written in another order behind a leading column that is no edge column."""
    path = scratch_path(spark, "edges-csv")
    edges = fx.sensor_edges(spark, sf)
    tables.export_csv(edges.select(F.lit(0).alias("row"), "weight", "destination_sensor", "source_sensor"), path)
    return tables.read_edges_csv(spark, path)


@query("s03_features_csv", fx.with_views("select * from speed_nullable"))
def s03(spark, sf):
    path = scratch_path(spark, "features-csv")
    tables.export_csv(fx.speed_nullable(spark, sf), path)
    schema = "sensor_id bigint, timestamp timestamp_ntz, speed double, event_id bigint"
    return tables.read_features_csv(spark, path, schema)


@query(
    "s10_checked_csv",
    """with broken as (
      select event_id::varchar as event_id, case when event_id % 5 = 1 then null else user_id::varchar end as sensor_id,
        case when event_id % 10 = 3 then 'n/a' when event_type <> 'error' then value::varchar end as speed, value,
        concat_ws(';', case when event_id % 5 = 1 then 'sensor_id missing' end, case when event_id % 10 = 3 then 'speed n/a not a double' end,
          case when event_id % 7 = 2 then 'day yesterday not a date' end) as faults from events)
    select case when faults = '' then 'good' else 'rejected' end as kind, event_id, sensor_id,
      case when speed <> 'n/a' then round(value + 0.000000001::double, 6) end as speed, faults from broken""",
)
def s10(spark, sf):
    """A file with broken numbers, broken dates and missing sensors: every row is in one of the two tables."""
    at = lambda n, k: F.col("event_id") % n == k
    known = F.when(F.col("event_type") != "error", F.col("value").cast("string"))
    broken = fx.table(spark, sf, "events").select(
        "event_id", F.when(~at(5, 1), F.col("user_id")).alias("sensor_id"), F.when(at(10, 3), "n/a").otherwise(known).alias("speed"),
        F.when(at(7, 2), "yesterday").alias("day"),
    )
    path = scratch_path(spark, "broken-csv")
    tables.export_csv(broken, path)
    good, rejected = rejects.read_csv_checked(spark, path, "event_id long, sensor_id long, speed double, day date", ["sensor_id"])
    text = F.transform(rejects.REJECTS, lambda x: F.concat_ws(" ", x["column"], x["text"], x["reason"]))
    texts = lambda df, kind, faults: df.select(
        F.lit(kind).alias("kind"), F.col("event_id").cast("string").alias("event_id"), F.col("sensor_id").cast("string").alias("sensor_id"),
        to_number("speed").alias("speed"), faults.alias("faults"),
    )
    return rounded(texts(good, "good", F.lit("")).union(texts(rejected, "rejected", F.array_join(text, ";"))))


@query("s04_gold_round_trip", fx.with_views(f"select *, {columns(CALENDAR)} from speed_long"))
def s04(spark, sf):
    path = scratch_path(spark, "gold")
    tables.write_gold(fx.speed_long(spark, sf), path)
    # A second write replaces rows and schema.
    tables.write_gold(calendar_columns(fx.speed_long(spark, sf)), path, partitions=50)
    return tables.read_table(spark, path)


@query("l05_repartition_round_trip", fx.with_views("select * from speed_long"))
def l05(spark, sf):
    path = scratch_path(spark, "gold")
    tables.write_gold(fx.speed_long(spark, sf), path, partitions=50, rows_per_file=1000)
    return tables.read_table(spark, path)


@query("s05_parquet_round_trip", fx.with_views("select * from sensor_edges"))
def s05(spark, sf):
    path = scratch_path(spark, "parquet")
    tables.export_parquet(fx.sensor_edges(spark, sf), path)
    return tables.read_table(spark, path)


@query(
    "s06_codec_round_trip",
    fx.with_views(
        "select codec, speed_long.* from speed_long, (values "
        + ", ".join(f"('{c}')" for c in CODECS)
        + ") codecs(codec)"
    ),
)
def s06(spark, sf):
    def round_trip(codec):
        path = scratch_path(spark, f"parquet-{codec}")
        tables.export_parquet(fx.speed_long(spark, sf), path, compression=codec)
        return tables.read_table(spark, path).select(F.lit(codec).alias("codec"), "*")

    return reduce(lambda a, b: a.union(b), map(round_trip, CODECS))


@query(
    "s07_csv_round_trip",
    fx.with_views(
        "select sensor_id, event_id, "
        + ", ".join(label_flags("time_of_day", 4))
        + f" from days {label_joins(['time_of_day'], 'days')}",
        days=f"select *, {CALENDAR['time_of_day']} as time_of_day from speed_long",
        **label_views("days", ["time_of_day"]),
    ),
)
def s07(spark, sf):
    days = calendar_columns(fx.speed_long(spark, sf))
    encoded = one_hot(label_index(days, ["time_of_day"]), ["time_of_day"])
    arrays = reshape.vectors_to_arrays(encoded.select("sensor_id", "event_id", "time_of_day_vector"))
    path = scratch_path(spark, "features-csv")
    tables.export_csv(arrays, path)
    flags = ", ".join(f"time_of_day_vector_{i} double" for i in range(4))
    return tables.read_features_csv(spark, path, f"sensor_id bigint, event_id bigint, {flags}")


@query(
    "s08_profile",
    fx.with_views(
        " union all ".join(
            f"select '{c}' as \"column\", '{t}' as type, count({c}) as non_null, count(*) as rows "
            "from speed_nullable"
            for c, t in (
                ("sensor_id", "bigint"), ("timestamp", "timestamp_ntz"),
                ("speed", "double"), ("event_id", "bigint"),
            )
        )
    ),
)
def s08(spark, sf):
    return inspect.profile(fx.speed_nullable(spark, sf))


@query(
    "s09_ingest_round_trip",
    fx.with_views(
        " union all ".join(
            f"select cast({i} as bigint) as sensor_id, timestamp, {r(t, 'speed')} from speed_wide"
            for t, i in WIDE_IDS.items()
        )
    ),
)
def s09(spark, sf):
    raw, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    wide = fx.speed_wide(spark, sf).withColumnsRenamed({"timestamp": "index"} | WIDE_IDS)
    tables.export_parquet(wide, raw)
    tables.ingest_speeds(spark, raw, silver, "index")
    return rounded(tables.read_table(spark, silver))


# Two deliveries that overlap by five days; a later event of a sensor and hour replaces an earlier one.
DELIVERIES = (("2024-01-01", "2024-01-20"), ("2024-01-15", "2025-01-01"))


@query(
    "s09_incremental_ingest",
    """select user_id as sensor_id, cast(date_trunc('hour', ts) as timestamp) as timestamp,
        arg_max(value, event_id) as speed, max(event_id) as event_id from events group by all""",
)
def s09_incremental(spark, sf):
    """Both deliveries merged into one silver table by sensor and hour."""
    silver = scratch_path(spark, "silver")
    hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
    for since, until in DELIVERIES:
        raw = scratch_path(spark, "bronze")
        within = F.col("timestamp").between(F.lit(since).cast("timestamp_ntz"), F.lit(until).cast("timestamp_ntz"))
        delivery = fx.speed_long(spark, sf).where(within).withColumn("timestamp", hour)
        tables.export_parquet(delivery.withColumnRenamed("timestamp", "index"), raw)
        tables.ingest_new_speeds(spark, raw, silver, "index", order="event_id")
    return tables.read_table(spark, silver).select("sensor_id", "timestamp", "speed", "event_id")


@query("s09_ingest_edges_round_trip", fx.with_views("select * from sensor_edges"))
def s09_edges(spark, sf):
    raw, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    text = fx.sensor_edges(spark, sf).select(*[F.col(c).cast("string") for c in reshape.EDGE_COLUMNS])
    tables.export_parquet(text, raw)
    tables.ingest_edges(spark, raw, silver)
    return tables.read_table(spark, silver)


@query("a06_count", "select count(*) as rows from events")
def a06(spark, sf):
    return fx.table(spark, sf, "events").agg(F.count("*").alias("rows"))


@query("l01_sample", fx.with_views("select * from speed_long order by timestamp, event_id limit 5"))
def l01(spark, sf):
    return inspect.sample_rows(fx.speed_long(spark, sf), ["timestamp", "event_id"], 5)


@query(
    "p01_wide_to_long",
    fx.with_views(
        " union all ".join(
            f"select timestamp, '{t}' as sensor_id, {r(t, 'speed')} from speed_wide" for t in fx.EVENT_TYPES
        )
    ),
)
def p01(spark, sf):
    return rounded(reshape.wide_to_long(fx.speed_wide(spark, sf)))


@query("p02_long_passthrough", fx.with_views("select * from speed_long"))
def p02(spark, sf):
    return reshape.wide_to_long(fx.speed_long(spark, sf))


@query("p03_matrix_to_edges", fx.with_views("select * from trade_edges where weight <> 0"))
def p03(spark, sf):
    return reshape.matrix_to_edges(fx.trade_matrix(spark, sf))


@query("p08_drop", "select event_id, ts, user_id, event_type, value from events")
def p08(spark, sf):
    return reshape.drop_if_present(fx.table(spark, sf, "events"), ["props", "features"])


@query(
    "p10_vectors_to_arrays",
    fx.with_views(
        "select event_id, "
        + ", ".join(label_flags("kind", 4))
        + f" from kinds {label_joins(['kind'], 'kinds')}",
        kinds="select event_id, case when event_type <> 'error' then event_type end as kind from events",
        **label_views("kinds", ["kind"]),
    ),
)
def p10(spark, sf):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    kinds = fx.table(spark, sf, "events").select("event_id", kind)
    arrays = reshape.vectors_to_arrays(one_hot(label_index(kinds, ["kind"]), ["kind"]))
    return reshape.flatten_arrays(arrays.select("event_id", "kind_vector"))


@query(
    "p11_semi_join",
    fx.with_views(
        """select * from speed_long where sensor_id in (
        select source_sensor from trade_edges union select destination_sensor from trade_edges)"""
    ),
)
def p11(spark, sf):
    return restrict_to_graph(fx.speed_long(spark, sf), fx.trade_edges(spark, sf))


@query("p12_drop_missing", fx.with_views("select * from speed_nullable where speed is not null"))
def p12(spark, sf):
    return reshape.drop_missing(fx.speed_nullable(spark, sf), ["speed"])


@query(
    "p13_fill_zero",
    fx.with_views("select sensor_id, timestamp, coalesce(speed, 0) as speed, event_id from speed_nullable"),
)
def p13(spark, sf):
    return reshape.fill_zero(fx.speed_nullable(spark, sf), ["speed"])


@query(
    "p14_fill_defaults",
    fx.with_views("select sensor_id, timestamp, coalesce(speed, 1.5) as speed, event_id from speed_nullable"),
)
def p14(spark, sf):
    return reshape.fill_defaults(fx.speed_nullable(spark, sf), {"speed": 1.5, "pagerank": 0.0})


@query("p15_to_number", "select event_id, case when event_type <> 'error' then value end as speed from events")
def p15(spark, sf):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return fx.table(spark, sf, "events").select("event_id", to_number(text).alias("speed"))


@query("p16_to_timestamp", "select event_id, case when event_type <> 'error' then ts end as timestamp from events")
def p16(spark, sf):
    text = F.when(F.col("event_type") == "error", "no time").otherwise(F.col("ts").cast("string"))
    return fx.table(spark, sf, "events").select("event_id", to_ts(text).alias("timestamp"))


@query("p16_other_formats", "select event_id, cast(date_trunc('second', ts) as timestamp) as timestamp from events")
def p16_formats(spark, sf):
    """Two formats beside ISO text, by the parity of the hour."""
    shapes = ("dd.MM.yyyy HH:mm:ss", "MM/dd/yyyy HH-mm-ss")
    text = F.when(F.hour("ts") % 2 == 0, F.date_format("ts", shapes[0])).otherwise(F.date_format("ts", shapes[1]))
    return fx.table(spark, sf, "events").select("event_id", to_ts(text, shapes).alias("timestamp"))
