"""Shared pieces of the checking SQL."""

from __future__ import annotations

LAGS, FRAMES, ITERATIONS = (1, 2, 3, 6, 12), (3, 6, 12), 10

CALENDAR = {
    "date": "cast(timestamp as date)",
    "hour": "cast(hour(timestamp) as int)",
    "minute": "cast(minute(timestamp) as int)",
    "day_of_week": "cast(dayofweek(timestamp) + 1 as int)",
    "day_of_month": "cast(dayofmonth(timestamp) as int)",
    "week_of_year": "cast(weekofyear(timestamp) as int)",
    "month": "cast(month(timestamp) as int)",
    "is_weekend": "cast(dayofweek(timestamp) in (0, 6) as int)",
    "is_peak_hour": "cast(hour(timestamp) between 7 and 9 or hour(timestamp) between 16 and 18 as int)",
    "time_of_day": """case when hour(timestamp) between 5 and 11 then 'Morning'
        when hour(timestamp) between 12 and 16 then 'Afternoon'
        when hour(timestamp) between 17 and 20 then 'Evening' else 'Night' end""",
}
CYCLIC = {
    "hour_sin": "sin(2 * pi() * hour(timestamp) / 24)",
    "hour_cos": "cos(2 * pi() * hour(timestamp) / 24)",
    "day_sin": "sin(2 * pi() * dayofweek(timestamp) / 7)",
    "day_cos": "cos(2 * pi() * dayofweek(timestamp) / 7)",
    "month_sin": "sin(2 * pi() * (month(timestamp) - 1) / 12)",
    "month_cos": "cos(2 * pi() * (month(timestamp) - 1) / 12)",
}
ORDER = "partition by sensor_id order by timestamp, event_id"
LAG = {f"lag_{k}": f"lag(speed, {k}) over ({ORDER})" for k in LAGS}
CHANGE = {"speed_change": f"speed - lag(speed, 1) over ({ORDER})"}
ROLLING = {
    f"rolling_{name}_{n}": f"{fn}(speed) over ({ORDER} rows between {n - 1} preceding and current row)"
    for n in FRAMES
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min"))
}
TARGET = {"target_speed": f"lead(speed, 1) over ({ORDER})"}
# A missing speed is the last label of its chain; so is a missing change.
LABELS = {
    "congestion_level": """case when speed > 60 then 'Free Flow' when speed >= 40 then 'Moderate'
        else 'Congested' end""",
    "speed_category": """case when speed < 40 then 'Low' when speed <= 60 then 'Medium'
        else 'High' end""",
    "traffic_trend": """case when speed_change > 0 then 'Increasing'
        when speed_change < 0 then 'Decreasing' else 'Stable' end""",
}
PERCENT = {"percent_change": "case when lag_1 <> 0 then (speed - lag_1) / lag_1 * 100 end"}

LABEL_WIDTHS = {"time_of_day": 4, "congestion_level": 3, "speed_category": 3, "traffic_trend": 3}
SCALED = [
    *[c for c in CALENDAR if c not in ("date", "time_of_day")],
    *LAG, *CHANGE, *ROLLING, *PERCENT, *CYCLIC,
]


def columns(*groups: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for g in groups for n, e in g.items())


def windowed(view: str) -> str:
    return f"select *, {columns(LAG, CHANGE, ROLLING, TARGET)} from {view}"


def frame_views(view: str = "speed_long") -> dict[str, str]:
    """``frame``: all series columns of rows with a target; ``filled``: numbers without NULL."""
    filled = ", ".join(f"coalesce({c}, 0) as {c}" for c in SCALED)
    return {
        "win": windowed(view),
        "frame": f"select *, {columns(CALENDAR, CYCLIC, LABELS, PERCENT)} from win "
        "where target_speed is not null",
        "filled": f"select * replace ({filled}) from frame",
    }


def label_views(view: str, labels) -> dict[str, str]:
    """``idx_<label>``: the index of every label, most frequent first, ties by name."""
    return {
        f"idx_{c}": f"select {c}, cast(row_number() over (order by count(*) desc, {c}) - 1 as double) as i "
        f"from {view} where {c} is not null group by {c}"
        for c in labels
    }


def label_flags(c: str, width: int, prefix: str = "") -> list[str]:
    """One-hot flags of the joined ``idx_<label>`` table."""
    return [
        f"case when {prefix}idx_{c}.i = {k} then 1.0::double else 0.0::double end as {c}_vector_{k}"
        for k in range(width)
    ]


def label_joins(labels, left: str) -> str:
    return " ".join(f"left join idx_{c} on {left}.{c} = idx_{c}.{c}" for c in labels)


def rank_views(edges: str, iterations: int = ITERATIONS) -> dict[str, str]:
    """``rank_<k>``: PageRank after k iterations, one view each."""
    views = {
        "vertex": f"select source_sensor as s from {edges} union select destination_sensor from {edges}",
        "pair": f"select source_sensor as a, destination_sensor as b, sum(weight) as w from {edges} group by all",
        "step": "select a, b, coalesce(w / nullif(sum(w) over (partition by a), 0), 0) as p from pair",
        "rank_0": "select s, 1.0::double as r from vertex",
    }
    for k in range(1, iterations + 1):
        views[f"rank_{k}"] = (
            f"select vertex.s, 0.15 + 0.85 * coalesce(x.q, 0) as r from vertex left join "
            f"(select b, sum(r * p) as q from step join rank_{k - 1} on a = s group by b) x on x.b = vertex.s"
        )
    return views


def end_view(edges: str) -> str:
    """Degrees, weights and neighbours per sensor."""
    return f"""select coalesce(o.s, i.s) as sensor_id,
        coalesce(o.n, 0) as out_degree, coalesce(i.n, 0) as in_degree,
        coalesce(o.n, 0) + coalesce(i.n, 0) as degree,
        coalesce(o.w, 0.0) as out_weight_degree, coalesce(i.w, 0.0) as in_weight_degree,
        coalesce(o.w, 0.0) + coalesce(i.w, 0.0) as weighted_degree,
        coalesce(o.d, 0) as neighbor_count, coalesce(o.a, 0.0) as avg_neighbor_weight
        from (select source_sensor as s, count(*) as n, sum(weight) as w,
            count(distinct destination_sensor) as d, avg(weight) as a from {edges} group by 1) o
        full join (select destination_sensor as s, count(*) as n, sum(weight) as w
            from {edges} group by 1) i on o.s = i.s"""


def link_views(edges: str) -> dict[str, str]:
    """``link``: symmetrically normalised links with a unit self-loop where there was none."""
    return {
        "pair": f"select source_sensor as a, destination_sensor as b, sum(weight) as w from {edges} group by all",
        "looped": """select a, b, w from pair union all
            select s, s, 1.0 from (select a as s from pair union select b from pair) v
            where not exists (select 1 from pair p where p.a = v.s and p.b = v.s)""",
        "arriving": "select b as s, sum(w) as d from looped group by b",
        "link": """select a, b, w / sqrt(x.d * y.d) as k from looped
            join arriving x on x.s = a join arriving y on y.s = b""",
    }


HOURLY_TARGET = """select sensor_id, timestamp, speed, target_speed from (
    select *, lead(speed) over (partition by sensor_id order by timestamp) as target_speed
    from speed_hourly) where target_speed is not null"""


def panel_views(cells: str) -> dict[str, str]:
    """``panel``: the dense grid over the times of ``cells`` and the sensors of the network."""
    return {
        "times": f"""select timestamp, row_number() over (order by timestamp) - 1 as time_index
            from (select distinct timestamp from {cells})""",
        "ids": """select sensor_id, row_number() over (order by sensor_id) - 1 as node_id
            from (select source_sensor as sensor_id from sensor_edges
                  union select destination_sensor from sensor_edges)""",
        "panel": f"""select t.timestamp, i.sensor_id, t.time_index, i.node_id,
            coalesce(c.speed, 0) as speed, coalesce(c.target_speed, 0) as target_speed
            from times t cross join ids i left join {cells} c
            on c.timestamp = t.timestamp and c.sensor_id = i.sensor_id""",
    }
