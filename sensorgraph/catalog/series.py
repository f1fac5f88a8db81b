"""Queries of the calendar, series, label and encoding operators."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sensorgraph.catalog import fixtures as fx
from sensorgraph.catalog import sqltext as st
from sensorgraph.catalog.registry import query, r, rounded
from sensorgraph.config import SeriesConfig
from sensorgraph.functions.calendar import calendar_columns, cyclic_columns
from sensorgraph.functions.labels import LABEL_COLUMNS, condition_columns
from sensorgraph.operators import encode, fitted, reshape, series, sketches
from sensorgraph.operators.storage import stored
from sensorgraph.plans.features import build_series_features, continue_frame, series_frame

KEYS = ["sensor_id", "timestamp", "event_id"]
KEY_SQL = ", ".join(KEYS)
BY_EVENT = SeriesConfig(tiebreak="event_id")


def _calendar_query(name, *cols):
    wanted = {c: st.CALENDAR[c] for c in cols}

    @query(name, fx.with_views(f"select {KEY_SQL}, {st.columns(wanted)} from speed_long"))
    def run(spark, sf):
        return calendar_columns(fx.speed_long(spark, sf)).select(*KEYS, *cols)


_calendar_query(
    "t01_calendar_parts",
    "date", "hour", "minute", "day_of_week", "day_of_month", "week_of_year", "month",
)
_calendar_query("t02_weekend", "is_weekend")
_calendar_query("t03_peak", "is_peak_hour")
_calendar_query("t04_time_of_day", "time_of_day")


@query(
    "t09_cyclic",
    fx.with_views(
        f"select {KEY_SQL}, {', '.join(r(e, n) for n, e in st.CYCLIC.items())} from speed_long"
    ),
)
def t09(spark, sf):
    return rounded(cyclic_columns(fx.speed_long(spark, sf)).select(*KEYS, *st.CYCLIC))


def _window_query(name, cols, run, view="speed_nullable", digits=6):
    picked = ", ".join(r(c, c, digits) for c in cols)

    @query(name, fx.with_views(f"select {KEY_SQL}, {picked} from win", win=st.windowed(view)))
    def windows(spark, sf):
        return rounded(run(getattr(fx, view)(spark, sf)).select(*KEYS, *cols), digits)


def _lags(df):
    return series.lag_columns(df, tiebreak="event_id")


def _rolling(df):
    return series.rolling_columns(df, tiebreak="event_id")


_window_query("w01_lags", list(st.LAG), _lags)
_window_query("w02_change", ["speed_change"], _lags)
for _position, (_name, _digits) in enumerate({"mean": 6, "std": 4, "max": 6, "min": 6}.items(), 3):
    _window_query(
        f"w0{_position}_rolling_{_name}", [f"rolling_{_name}_{n}" for n in st.FRAMES], _rolling,
        digits=_digits,
    )


@query(
    "w09_cut_windows",
    fx.with_views(
        f"select {KEY_SQL}, "
        + ", ".join(r(c, c, 4 if "std" in c else 6) for c in [*st.LAG, *st.CHANGE, *st.ROLLING, *st.TARGET])
        + " from win",
        win=st.windowed("speed_nullable"),
    ),
)
def w09(spark, sf):
    """All window columns with every series cut into pieces of about 16 rows."""
    cut = SeriesConfig(tiebreak="event_id", rows_per_task=16)
    windows = series.series_columns(fx.speed_nullable(spark, sf), cut).drop("speed")
    return rounded(windows, **{c: 4 for c in st.ROLLING if "std" in c})


OUTLYING = (
    "select min(user_id)::bigint as sensor_id, timestamp '1970-01-01 00:00:00' as timestamp, "
    "1::double as speed, (-1)::bigint as event_id from events"
)


@query(
    "w09_cut_windows_outlier",
    fx.with_views(
        f"select {KEY_SQL}, "
        + ", ".join(r(c, c, 4 if "std" in c else 6) for c in [*st.LAG, *st.CHANGE, *st.ROLLING, *st.TARGET])
        + " from win",
        with_far=f"select * from speed_nullable union all {OUTLYING}",
        win=st.windowed("with_far"),
    ),
)
def w09_outlier(spark, sf):
    """The same with one reading of one sensor at the epoch, far before all others."""
    far = fx.table(spark, sf, "events").selectExpr("min(user_id) as user_id").selectExpr(
        "cast(user_id as bigint) as sensor_id", "timestamp_ntz'1970-01-01 00:00:00' as timestamp",
        "cast(1 as double) as speed", "cast(-1 as bigint) as event_id",
    )
    cut = SeriesConfig(tiebreak="event_id", rows_per_task=16)
    windows = series.series_columns(fx.speed_nullable(spark, sf).unionByName(far), cut).drop("speed")
    return rounded(windows, **{c: 4 for c in st.ROLLING if "std" in c})


# Ends of deliveries; the readings up to each are handed over together.
DELIVERIES = ("2024-01-03", "2024-01-04", "2024-01-12", "2025-01-01")


@query(
    "w10_continued_windows",
    fx.with_views(
        f"select {KEY_SQL}, "
        + ", ".join(r(c, c, 4 if "std" in c else 6) for c in [*st.LAG, *st.CHANGE, *st.ROLLING, *st.TARGET])
        + f", {st.columns(st.LABELS)}, {', '.join(st.CALENDAR[c] + ' as ' + c for c in ('hour', 'time_of_day'))} from win where target_speed is not null",
        win=st.windowed("speed_nullable"),
    ),
)
def w10(spark, sf):
    """All series columns, delivery by delivery, each from the stored carry of the one before."""
    readings, state, since, found = fx.speed_nullable(spark, sf), None, None, None
    for until in DELIVERIES:
        end = F.lit(until).cast("timestamp_ntz")
        new = readings.where(F.col("timestamp") < end)
        new = new if since is None else new.where(F.col("timestamp") >= since)
        rows, state = continue_frame(new, state, BY_EVENT)
        rows, state, since = stored(rows, "continued-rows"), stored(state, "carry"), end
        found = rows if found is None else found.unionByName(rows)
    picked = found.select(*KEYS, *st.LAG, *st.CHANGE, *st.ROLLING, *st.TARGET, *st.LABELS, "hour", "time_of_day")
    return rounded(picked, **{c: 4 for c in st.ROLLING if "std" in c})


@query(
    "w07_target",
    fx.with_views(
        f"select {KEY_SQL}, speed, target_speed from win where target_speed is not null",
        win=st.windowed("speed_nullable"),
    ),
)
def w07(spark, sf):
    return series.next_target(fx.speed_nullable(spark, sf), tiebreak="event_id")


def _label_query(name, col, expression):
    @query(
        name,
        fx.with_views(f"select {KEY_SQL}, {expression} from win", win=st.windowed("speed_nullable")),
    )
    def run(spark, sf):
        labelled = condition_columns(_lags(fx.speed_nullable(spark, sf)))
        return rounded(labelled.select(*KEYS, col))


for _name, _col in (
    ("t05_congestion", "congestion_level"), ("t06_category", "speed_category"), ("t07_trend", "traffic_trend"),
):
    _label_query(_name, _col, f"{st.LABELS[_col]} as {_col}")
_label_query("t08_percent_change", "percent_change", r(st.PERCENT["percent_change"], "percent_change"))


@query(
    "a01_sensor_statistics",
    fx.with_views(
        f"""select sensor_id, {r("avg(speed)", "average_speed")}, max(speed) as maximum_speed,
        min(speed) as minimum_speed, quantile_disc(speed, 0.5) as median_speed,
        {r("stddev_samp(speed)", "standard_deviation", 4)}, {r("var_samp(speed)", "variance", 4)}
        from speed_long group by sensor_id"""
    ),
)
def a01(spark, sf):
    statistics = series.sensor_statistics(fx.speed_long(spark, sf))
    return rounded(statistics, standard_deviation=4, variance=4)


@query(
    "a01_sketched_statistics",
    fx.with_views(
        f"""select sensor_id, count(speed) as readings, {r("avg(speed)", "average_speed")}, max(speed) as maximum_speed,
        min(speed) as minimum_speed, true as median_within, true as upper_within from speed_nullable group by sensor_id having count(speed) > 0
        union all select -1, count(speed), {r("avg(speed)", "average_speed")}, max(speed), min(speed), true, true from speed_nullable"""
    ),
)
def a01_sketched(spark, sf):
    """From daily sketches: exact statistics, and whether the quantiles' ranks lie within the stated error (-1: all sensors)."""
    readings = fx.speed_nullable(spark, sf)
    daily = stored(sketches.reading_sketches(readings), "daily-sketches")
    every = daily.withColumn("sensor_id", F.lit(-1).cast("long"))
    found = stored(sketches.merged_statistics(daily.unionByName(every), quantiles=(0.5, 0.9)), "sketched")
    known = readings.where(F.col("speed").isNotNull()).select("sensor_id", "speed")
    known = known.unionByName(known.withColumn("sensor_id", F.lit(-1).cast("long")))
    share = lambda rows: F.avg(rows.cast("int"))
    within = lambda q, p: (share(F.col("speed") < F.col(q)) <= p + sketches.RANK_ERROR) & (share(F.col("speed") <= F.col(q)) >= p - sketches.RANK_ERROR)
    held = known.join(found, "sensor_id").groupBy("sensor_id").agg(within("quantile_50", 0.5).alias("median_within"), within("quantile_90", 0.9).alias("upper_within"))
    return rounded(found.drop("quantile_50", "quantile_90").join(held, "sensor_id"))


@query(
    "a04_sketched_neighbours",
    fx.with_views("select source_sensor, count(distinct destination_sensor) as neighbours, true as within from supply_edges group by source_sensor"),
)
def a04_sketched(spark, sf):
    """Distinct neighbours from sketches of four parts of the edges, against the exact count and the stated error."""
    edges = fx.supply_edges(spark, sf).withColumn("part", F.pmod(F.xxhash64("destination_sensor", "weight"), F.lit(4)))
    parts = stored(sketches.distinct_sketches(edges, ["source_sensor", "part"], "destination_sensor"), "neighbour-sketches")
    merged = sketches.merged_distinct(parts, ["source_sensor"])
    exact = edges.groupBy("source_sensor").agg(F.countDistinct("destination_sensor").alias("neighbours"))
    error = F.abs(F.col("distinct_count") - F.col("neighbours")) <= F.greatest(F.lit(1.0), F.col("neighbours") * sketches.DISTINCT_ERROR)
    return exact.join(merged, "source_sensor").select("source_sensor", "neighbours", error.alias("within"))


# Labels of rows with missing speeds, and one label column that is itself missing in places.
LABELLED = [*LABEL_COLUMNS, "kind"]
LABELLED_VIEWS = {
    "kinds": """select user_id as sensor_id, ts as timestamp, event_id,
        case when event_type <> 'error' then value end as speed,
        case when event_type <> 'error' then event_type end as kind from events""",
    "win": st.windowed("kinds"),
    "labelled": f"select *, {st.columns(st.LABELS)}, {st.CALENDAR['time_of_day']} as time_of_day from win",
    **st.label_views("labelled", LABELLED),
}


def labelled(spark, sf):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    speeds = fx.table(spark, sf, "events").select(
        F.col("user_id").alias("sensor_id"), F.col("ts").alias("timestamp"), "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("speed"), kind,
    )
    return calendar_columns(condition_columns(_lags(speeds))).select("event_id", *LABELLED)


@query(
    "e01_label_index",
    fx.with_views(
        "select event_id, "
        + ", ".join(
            f"coalesce(idx_{c}.i, (select count(*) from idx_{c})::double) as {c}_index" for c in LABELLED
        )
        + f" from labelled {st.label_joins(LABELLED, 'labelled')}",
        **LABELLED_VIEWS,
    ),
)
def e01(spark, sf):
    indexed = encode.label_index(labelled(spark, sf), LABELLED)
    return indexed.select("event_id", *[f"{c}_index" for c in LABELLED])


# Every user and every minute is a label: far more of them than the driver is allowed to hold.
MANY = ["who", "minute", "kind"]
MANY_VIEWS = {
    "many": """select event_id, 'user ' || user_id as who, strftime(ts, '%Y-%m-%d %H:%M') as minute,
        case when event_type <> 'error' then event_type end as kind from events""",
    **st.label_views("many", MANY),
}


def _many_labels_query(name, **options):
    @query(
        name,
        fx.with_views(
            "select event_id, "
            + ", ".join(f"coalesce(idx_{c}.i, (select count(*) from idx_{c})::double) as {c}_index" for c in MANY)
            + f" from many {st.label_joins(MANY, 'many')}",
            **MANY_VIEWS,
        ),
    )
    def run(spark, sf):
        texts = fx.table(spark, sf, "events").select(
            "event_id", F.concat(F.lit("user "), F.col("user_id")).alias("who"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"),
            F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        )
        if options:
            indexed = encode.index_labels(texts, encode.label_dictionary(texts, MANY), MANY, **options)
        else:
            indexed = encode.label_index(texts, MANY, most_labels=100)
        return indexed.select("event_id", *[f"{c}_index" for c in MANY])


_many_labels_query("e01_many_labels")
# The way beyond the broadcast limit: the three most frequent labels are broadcast, the rest is shuffled.
_many_labels_query("e01_many_labels_shuffled", broadcast_rows=0, hot_labels=3)


@query(
    "e02_one_hot_flags",
    fx.with_views(
        "select event_id, "
        + ", ".join(f for c in LABELLED for f in st.label_flags(c, st.LABEL_WIDTHS.get(c, 4)))
        + f" from labelled {st.label_joins(LABELLED, 'labelled')}",
        **LABELLED_VIEWS,
    ),
)
def e02(spark, sf):
    encoded = encode.one_hot(encode.label_index(labelled(spark, sf), LABELLED), LABELLED)
    vectors = encoded.select("event_id", *[f"{c}_vector" for c in LABELLED])
    return reshape.flatten_arrays(reshape.vectors_to_arrays(vectors))


@query(
    "a09_label_frequency",
    fx.with_views(
        " union all ".join(
            f"select '{c}' as \"column\", {c} as label, count(*) as count from labelled "
            f"where {c} is not null group by {c}"
            for c in LABELLED
        ),
        **{k: LABELLED_VIEWS[k] for k in ("kinds", "win", "labelled")},
    ),
)
def a09(spark, sf):
    return encode.label_frequency(labelled(spark, sf), LABELLED)


SAMPLE = ["speed", "hour", "day_of_week", "speed_change"]
SAMPLE_VIEWS = {
    "win": st.windowed("speed_long"),
    "numbers": f"select {KEY_SQL}, speed, {st.CALENDAR['hour']} as hour, "
    f"{st.CALENDAR['day_of_week']} as day_of_week, speed_change from win",
}


def numbers(spark, sf):
    return calendar_columns(_lags(fx.speed_long(spark, sf))).select(*KEYS, *SAMPLE)


def _elements(df, vector, width):
    array = vector_to_array(vector)
    return df.select("event_id", *[array[i].alias(f"{vector}_{i}") for i in range(width)])


@query(
    "e03_assemble",
    fx.with_views(
        "select event_id, "
        + ", ".join(r(f"coalesce({c}, 0)::double", f"numeric_{i}") for i, c in enumerate(SAMPLE))
        + " from numbers",
        **SAMPLE_VIEWS,
    ),
)
def e03(spark, sf):
    return rounded(_elements(encode.assemble(numbers(spark, sf), SAMPLE, "numeric"), "numeric", len(SAMPLE)))


@query(
    "e04_minmax",
    fx.with_views(
        f"select {KEY_SQL}, "
        + ", ".join(
            r(f"({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ())::double", c) for c in SAMPLE
        )
        + ", 0.5::double as constant from numbers",
        **SAMPLE_VIEWS,
    ),
)
def e04(spark, sf):
    frame = numbers(spark, sf).withColumn("constant", F.lit(7.0))
    return rounded(encode.minmax_scale(frame, [*SAMPLE, "constant"]))


@query(
    "e06_standard_scale",
    fx.with_views(
        f"select {KEY_SQL}, "
        + ", ".join(r(f"({c} - avg({c}) over ()) / stddev_pop({c}) over ()", c) for c in SAMPLE)
        + ", 0.0::double as constant from numbers",
        **SAMPLE_VIEWS,
    ),
)
def e06(spark, sf):
    frame = numbers(spark, sf).withColumn("constant", F.lit(7.0))
    return rounded(encode.standard_scale(frame, [*SAMPLE, "constant"]))


@query(
    "a07_mean_std",
    fx.with_views(
        "select "
        + ", ".join(r(f"avg({c})", f"{c}_mean") for c in SAMPLE)
        + ", "
        + ", ".join(r(f"stddev_pop({c})", f"{c}_std", 4) for c in SAMPLE)
        + " from numbers",
        **SAMPLE_VIEWS,
    ),
)
def a07(spark, sf):
    return rounded(
        encode.column_moments(numbers(spark, sf), SAMPLE), **{f"{c}_std": 4 for c in SAMPLE}
    )


@query(
    "a08_min_max",
    fx.with_views(
        "select "
        + ", ".join(r(f"{f}({c})::double", f"{c}_{f}") for f in ("min", "max") for c in SAMPLE)
        + " from numbers",
        **SAMPLE_VIEWS,
    ),
)
def a08(spark, sf):
    return rounded(encode.column_ranges(numbers(spark, sf), SAMPLE))


@query(
    "e08_scale_by_merged_state",
    fx.with_views(
        f"select {KEY_SQL}, "
        + ", ".join(r(f"({c} - avg({c}) over ()) / stddev_pop({c}) over ()", f"{c}_standard") for c in SAMPLE)
        + ", "
        + ", ".join(r(f"({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ())::double", f"{c}_range") for c in SAMPLE)
        + ", time_of_day_index from (select numbers.*, idx_time_of_day.i as time_of_day_index from numbers "
        + f"join (select event_id, {st.CALENDAR['time_of_day']} as time_of_day from speed_long) d using (event_id) {st.label_joins(['time_of_day'], 'd')})",
        **SAMPLE_VIEWS,
        days=f"select {st.CALENDAR['time_of_day']} as time_of_day from speed_long",
        **st.label_views("days", ["time_of_day"]),
    ),
)
def e08(spark, sf):
    """Scaled and indexed by the stored state of three parts, fitted one by one and merged."""
    frame = stored(calendar_columns(_lags(fx.speed_long(spark, sf))).select(*KEYS, *SAMPLE, "time_of_day"), "frame")
    parts = [stored(fitted.fit_state(frame.where(F.col("event_id") % 3 == k), SAMPLE, ["time_of_day"]), "state") for k in range(3)]
    state = stored(fitted.merge_states(fitted.merge_states(*parts[:2]), parts[2]), "state")
    frame = frame.withColumns({f"{c}_{way}": F.col(c) for c in SAMPLE for way in ("standard", "range")})
    for way, scale in (("standard", fitted.standard_scale_by), ("range", fitted.minmax_scale_by)):
        renamed = state.withColumn("column", F.when(F.col("kind") == fitted.NUMBER, F.concat("column", F.lit(f"_{way}"))).otherwise(F.col("column")))
        frame = scale(frame, renamed, [f"{c}_{way}" for c in SAMPLE])
    indexed = fitted.index_labels_by(frame, state, ["time_of_day"])
    return rounded(indexed.select(*KEYS, *[f"{c}_{way}" for way in ("standard", "range") for c in SAMPLE], "time_of_day_index"))


@query(
    "a07_merged_state",
    fx.with_views(
        " union all ".join(
            f"select '{c}' as \"column\", count({c}) as count, {r(f'avg({c})', 'mean')}, {r(f'stddev_pop({c})', 'std', 4)}, {r(f'min({c})::double', 'low')}, {r(f'max({c})::double', 'high')} from numbers"
            for c in SAMPLE
        ),
        **SAMPLE_VIEWS,
    ),
)
def a07_merged(spark, sf):
    """Moments and ranges of all readings, merged from the states of the single weekdays."""
    frame = stored(numbers(spark, sf), "numbers")
    parts = [fitted.fit_state(frame.where(F.col("day_of_week") == day), SAMPLE) for day in range(1, 8)]
    merged = fitted.merge_states(*parts)
    return rounded(merged.select("column", "count", "mean", F.sqrt(F.col("deviations") / F.col("count")).alias("std"), "low", "high"), std=4)


def series_range(c: str) -> str:
    """A column mapped to its range."""
    low, high = f"min({c}) over ()", f"max({c}) over ()"
    return f"case when {low} = {high} then 0.5 else ({c} - {low})::double / ({high} - {low}) end"


@query(
    "e05_feature_vector",
    fx.with_views(
        "select event_id, "
        + ", ".join(
            r(e, f"features_{i}", 5)
            for i, e in enumerate(
                [series_range(c) for c in st.SCALED]
                + [
                    f"(idx_{c}.i = {k})::int::double"
                    for c, width in st.LABEL_WIDTHS.items()
                    for k in range(width)
                ]
            )
        )
        + f" from filled {st.label_joins(LABEL_COLUMNS, 'filled')}",
        **st.frame_views(),
        **st.label_views("frame", LABEL_COLUMNS),
    ),
)
def e05(spark, sf):
    built = build_series_features(fx.speed_long(spark, sf), BY_EVENT)
    width = len(st.SCALED) + sum(st.LABEL_WIDTHS.values())
    return rounded(_elements(built, "features", width), 5)


SERIES_NUMBERS = [c for c in st.SCALED if c not in st.CALENDAR]


def series_sql(prefix: str) -> str:
    """Select list of the series part of the feature tables."""
    plain = [c for c in st.CALENDAR] + list(st.LABELS) + ["target_speed"]
    return ", ".join(
        [f"{prefix}.{c}" for c in ("sensor_id", "timestamp", "speed", *plain)]
        + [r(f"{prefix}.{c}", c, 4 if "std" in c else 6) for c in SERIES_NUMBERS]
        + [f"idx_{c}.i as {c}_index" for c in LABEL_COLUMNS]
        + [f for c, width in st.LABEL_WIDTHS.items() for f in st.label_flags(c, width)]
    )


def shown(df):
    """Feature tables with arrays as columns and numbers rounded for comparison."""
    flat = reshape.flatten_arrays(
        reshape.vectors_to_arrays(df), {f"{c}_vector": width for c, width in st.LABEL_WIDTHS.items()}
    )
    return rounded(flat, **{c: 4 for c in SERIES_NUMBERS if "std" in c})


@query(
    "e07_series_features",
    fx.with_views(
        f"select filled.event_id, {series_sql('filled')} from filled {st.label_joins(LABEL_COLUMNS, 'filled')}",
        **st.frame_views("speed_nullable"),
        **st.label_views("frame", LABEL_COLUMNS),
    ),
)
def e07(spark, sf):
    return shown(build_series_features(fx.speed_nullable(spark, sf), BY_EVENT, vectors=False))


@query(
    "e07_fit_on_train",
    fx.with_views(
        "select filled.event_id, "
        + ", ".join(
            f"coalesce(idx_{c}.i, (select count(*) from idx_{c})::double) as {c}_index" for c in LABEL_COLUMNS
        )
        + f" from filled {st.label_joins(LABEL_COLUMNS, 'filled')}",
        **st.frame_views(),
        early="select * from frame where timestamp < timestamp '2024-01-25'",
        **st.label_views("early", LABEL_COLUMNS),
    ),
)
def e07_fit(spark, sf):
    speeds = fx.speed_long(spark, sf)
    early = series_frame(speeds, BY_EVENT).where(
        F.col("timestamp") < F.lit("2024-01-25").cast("timestamp_ntz")
    )
    built = build_series_features(speeds, BY_EVENT, vectors=False, fit_df=early)
    return built.select("event_id", *[f"{c}_index" for c in LABEL_COLUMNS])
