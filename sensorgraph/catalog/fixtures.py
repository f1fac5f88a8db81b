"""The input shapes of the job as views over the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgraph.operators.ordered import over_ordered

# The event types and nations that the SQL side names. The Spark side reads its pivot columns from the
# tables, so a value that is missing here shows as a difference.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
NATIONS = tuple(range(25))
SUPPLIER_OFFSET = 1_000_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def speed_long(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("sensor_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("speed"),
        "event_id",
    )


def speed_nullable(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("sensor_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("speed"),
        "event_id",
    )


def _hour() -> F.Column:
    return F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")


def speed_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("sensor_id"), _hour())
        .agg(F.avg("value").alias("speed"))
    )


def speed_wide(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy(_hour())
        .pivot("event_type", sorted(r[0] for r in table(spark, folder, "events").select("event_type").distinct().collect()))
        .agg(F.avg("value"))
    )


def sensor_edges(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    linked = over_ordered(
        events,
        ["event_type", "day"],
        ["ts", "event_id"],
        lambda w: {"next_user": F.lead("user_id").over(w)},
        after=1,
    )
    return linked.where(F.col("next_user").isNotNull()).select(
        F.col("user_id").alias("source_sensor"),
        F.col("next_user").alias("destination_sensor"),
        F.col("value").alias("weight"),
    )


def supply_edges(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("source_sensor"),
        (F.col("l_suppkey") + SUPPLIER_OFFSET).alias("destination_sensor"),
        F.col("l_quantity").alias("weight"),
    )


def trade_edges(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customers, suppliers = table(spark, folder, "customer"), table(spark, folder, "supplier")
    per_pair = (
        table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "l_suppkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    return (
        per_pair.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            F.col("s_nationkey").alias("source_sensor"),
            F.col("c_nationkey").alias("destination_sensor"),
        )
        .agg(F.sum("quantity").alias("weight"))
    )


def trade_matrix(spark: SparkSession, folder: str) -> DataFrame:
    nations = sorted(r[0] for r in table(spark, folder, "nation").select("n_nationkey").distinct().collect())
    return (
        trade_edges(spark, folder)
        .groupBy("source_sensor")
        .pivot("destination_sensor", nations)
        .agg(F.sum("weight"))
        .fillna(0.0)
    )


VIEWS = {
    "speed_long": "select user_id as sensor_id, ts as timestamp, value as speed, event_id from events",
    "speed_nullable": """select user_id as sensor_id, ts as timestamp,
        case when event_type <> 'error' then value end as speed, event_id from events""",
    "speed_hourly": """select user_id as sensor_id, cast(date_trunc('hour', ts) as timestamp) as timestamp,
        avg(value) as speed from events group by all""",
    "speed_wide": "select cast(date_trunc('hour', ts) as timestamp) as timestamp, "
    + ", ".join(f"avg(value) filter (where event_type = '{t}') as {t}" for t in EVENT_TYPES)
    + " from events group by all",
    "sensor_edges": """select user_id as source_sensor, nxt as destination_sensor, value as weight from (
        select user_id, value, lead(user_id) over (
            partition by event_type, cast(ts as date) order by ts, event_id) as nxt
        from events) where nxt is not null""",
    "supply_edges": f"""select o_custkey as source_sensor, {SUPPLIER_OFFSET} + l_suppkey as destination_sensor,
        l_quantity as weight from lineitem join orders on l_orderkey = o_orderkey""",
    "trade_edges": """select s_nationkey as source_sensor, c_nationkey as destination_sensor,
        sum(l_quantity) as weight from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey group by all""",
}


def with_views(body: str, **views: str) -> str:
    """``body`` behind the views that it or another view mentions; ``views`` come last, in order."""
    wanted = [n for n in VIEWS if n in body or any(n in v for v in views.values())]
    parts = [f"{n} as ({VIEWS[n]})" for n in wanted] + [f"{n} as ({v})" for n, v in views.items()]
    return f"with {', '.join(parts)} {body}" if parts else body
