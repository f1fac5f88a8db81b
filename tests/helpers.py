"""Small frames and row access shared by the tests."""

import datetime as dt

DAY = dt.datetime(2024, 1, 6, 8, 0)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def speeds(spark, rows, schema="sensor_id long, timestamp timestamp_ntz, speed double"):
    return spark.createDataFrame(rows, schema)


def edges(spark, rows):
    return spark.createDataFrame(rows, "source_sensor long, destination_sensor long, weight double")


def values(df, *columns, by):
    """Tuples of ``columns``, doubles rounded, in the order of ``by``."""
    names = columns or df.columns
    return [
        tuple(round(v, 6) if isinstance(v, float) else v for v in (row[c] for c in names))
        for row in df.orderBy(*by).collect()
    ]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
