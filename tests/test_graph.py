import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorgraph.config import GraphConfig
from sensorgraph.operators import graph, tiles
from sensorgraph.plans.features import build_graph_features
from tests.helpers import at, edges, plan, values

GOLDEN = [(1, 2, 2.0), (1, 3, 1.0), (2, 3, 3.0), (4, 4, 5.0)]


def random_edges(seed, n=400, nodes=30):
    """A hub sends a third of the edges; pairs repeat, some edges are self-loops or weightless."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        source = 0 if draw.random() < 0.34 else draw.randrange(nodes)
        rows.append((source, draw.randrange(nodes + 5), float(draw.choice([0, 1, 2, 5]))))
    return rows


def brute_rank(rows, iterations, reset=0.15):
    out = {}
    for s, _, w in rows:
        out[s] = out.get(s, 0.0) + w
    ranks = {v: 1.0 for s, d, _ in rows for v in (s, d)}
    for _ in range(iterations):
        sums = dict.fromkeys(ranks, 0.0)
        for s, d, w in rows:
            if out[s]:
                sums[d] += ranks[s] * w / out[s]
        ranks = {v: reset + (1 - reset) * q for v, q in sums.items()}
    return ranks


def close(found, wanted):
    assert found.keys() == wanted.keys()
    for key, value in wanted.items():
        assert found[key] == pytest.approx(value, abs=1e-9), key


def test_end_features_golden(spark):
    df = graph.edge_end_features(edges(spark, GOLDEN))
    assert values(df, by=["sensor_id"]) == [
        (1, 2, 0, 2, 3.0, 0.0, 3.0, 2, 1.5),
        (2, 1, 1, 2, 3.0, 2.0, 5.0, 1, 3.0),
        (3, 0, 2, 2, 0.0, 4.0, 4.0, 0, 0.0),
        (4, 1, 1, 2, 5.0, 5.0, 10.0, 1, 5.0),
    ]


def test_degrees_count_edge_rows_and_neighbours_count_pairs(spark):
    df = graph.edge_end_features(edges(spark, [(1, 2, 1.0), (1, 2, 4.0), (1, 1, None)]))
    row = df.where("sensor_id = 1").first().asDict()
    assert (row["out_degree"], row["in_degree"], row["neighbor_count"]) == (3, 1, 2)
    assert row["avg_neighbor_weight"] == 2.5  # missing weights do not count


def test_degree_sums_equal_edge_rows(spark):
    rows = random_edges(1)
    df = graph.edge_end_features(edges(spark, rows))
    assert tuple(df.agg(F.sum("out_degree"), F.sum("in_degree")).first()) == (len(rows), len(rows))


def test_vertices(spark):
    assert values(graph.vertices(edges(spark, GOLDEN)), by=["sensor_id"]) == [(1,), (2,), (3,), (4,)]


def test_transitions_sum_to_one(spark):
    rows = random_edges(2)
    sums = graph.transitions(edges(spark, rows)).groupBy("source_sensor").agg(F.sum("transition").alias("t"))
    weight = {}
    for s, _, w in rows:
        weight[s] = weight.get(s, 0) + w
    for row in sums.collect():
        assert row["t"] == pytest.approx(1.0 if weight[row["source_sensor"]] else 0.0)


@pytest.mark.parametrize(
    "iterations, expected",
    [
        (0, [1.0, 1.0, 1.0, 1.0]),
        (1, [0.15, 0.716667, 1.283333, 1.0]),
        (2, [0.15, 0.235, 0.801667, 1.0]),
        (10, [0.15, 0.235, 0.39225, 1.0]),
    ],
)
def test_pagerank_golden(spark, iterations, expected):
    df = graph.pagerank(edges(spark, GOLDEN), iterations)
    assert [r for (r,) in values(df, "pagerank", by=["sensor_id"])] == expected


def test_pagerank_with_zero_weight_edge(spark):
    df = graph.pagerank(edges(spark, [*GOLDEN, (3, 1, 0.0)]))
    assert [r for (r,) in values(df, "pagerank", by=["sensor_id"])] == [0.15, 0.235, 0.39225, 1.0]


@pytest.mark.parametrize("broadcast_rows, links_per_slot", [(10**6, 10**6), (0, 10**6), (0, 5)])
def test_pagerank_equals_brute_force(spark, broadcast_rows, links_per_slot):
    rows = random_edges(3)
    df = graph.pagerank(
        edges(spark, rows), 7, 0.2, store_every=3,
        broadcast_rows=broadcast_rows, links_per_slot=links_per_slot,
    )
    close({r["sensor_id"]: r["pagerank"] for r in df.collect()}, brute_rank(rows, 7, 0.2))


def test_hub_links_are_spread(spark):
    rows = [(0, i, 1.0) for i in range(300)] + [(i, 0, 1.0) for i in range(1, 60)]
    spread = graph.SpreadLinks(edges(spark, rows), links_per_slot=40)
    sizes = spread.links.groupBy("source_sensor", "slot").count()
    assert sizes.agg(F.max("count")).first()[0] < 100
    assert spread.links.count() == len(rows)
    ranks = spark.createDataFrame([(i, float(i)) for i in range(300)], "sensor_id long, pagerank double")
    assert spread.join(ranks, "sensor_id").count() == len(rows)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spread.join(ranks, "sensor_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # The bucketed links stay where they are; only the values travel.
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert "Exchange hashpartitioning(source_sensor" not in text


def brute_propagate(rows, panel, hops):
    nodes = sorted({v for s, d, _ in rows for v in (s, d)})
    at_ = {v: i for i, v in enumerate(nodes)}
    a = np.zeros((len(nodes), len(nodes)))
    looped = set()
    for s, d, w in rows:
        a[at_[s], at_[d]] += w
        if s == d:
            looped.add(s)
    for v in nodes:
        if v not in looped:
            a[at_[v], at_[v]] = 1.0
    d = a.sum(axis=0)
    root = np.array([1 / np.sqrt(x) if x > 0 else 0.0 for x in d])
    m = a * root[:, None] * root[None, :]
    result = {}
    for t in {t for t, _ in panel}:
        x = np.array([panel.get((t, v), 0.0) for v in nodes])
        for _ in range(hops):
            x = m.T @ x
        result |= {(t, v): x[at_[v]] for v in nodes}
    return result


def test_propagation_golden(spark):
    panel = spark.createDataFrame(
        [(at(0), i, float(i)) for i in range(1, 5)], "timestamp timestamp_ntz, sensor_id long, speed double"
    )
    df = graph.propagate(panel, edges(spark, GOLDEN), ["speed"])
    assert values(df, "sensor_id", "speed", by=["sensor_id"]) == [
        (1, 1.0), (2, 1.821367), (3, 2.596407), (4, 4.0)
    ]


@pytest.mark.parametrize("broadcast_rows, links_per_slot", [(10**6, 10**6), (0, 10**6), (0, 5)])
@pytest.mark.parametrize("hops", [1, 2])
def test_propagation_equals_brute_force(spark, broadcast_rows, links_per_slot, hops):
    rows = [r for r in random_edges(4, 200, 12) if r[2]]
    nodes = {v for s, d, _ in rows for v in (s, d)}
    panel = {(at(t), v): float((t * 7 + v * 3) % 11) for t in range(4) for v in nodes}
    df = spark.createDataFrame(
        [(t, v, x) for (t, v), x in panel.items()], "timestamp timestamp_ntz, sensor_id long, speed double"
    )
    found = graph.propagate(
        df, edges(spark, rows), ["speed"], hops, broadcast_rows=broadcast_rows, links_per_slot=links_per_slot
    )
    close(
        {(r["timestamp"], r["sensor_id"]): r["speed"] for r in found.collect()},
        brute_propagate(rows, panel, hops),
    )


def test_propagation_needs_no_shuffle_after_placing_rows_by_time(spark):
    panel = spark.createDataFrame([(at(t), 1, 1.0) for t in range(40)], "timestamp timestamp_ntz, sensor_id long, speed double")
    text = plan(graph.propagate(panel, edges(spark, GOLDEN), ["speed"], hops=2))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastHashJoin") == 3  # the sensors of the network, and the links of each hop
    few = plan(graph.propagate(panel.where(F.col("timestamp") < at(3)), edges(spark, GOLDEN), ["speed"], hops=2))
    assert "hashpartitioning(timestamp" in few and "destination_sensor" in few  # not by time alone


def test_propagation_joins_blocks_instead_of_rows(spark, monkeypatch):
    """A hub of 300 links over 400 times: the join has a row per strip and tile, not one per link and time."""
    monkeypatch.setattr(tiles, "LINKS_PER_STRIP", 100)
    joined = []
    multiply = tiles.multiply
    monkeypatch.setattr(tiles, "multiply", lambda rows, *rest: joined.append(rows.count()) or multiply(rows, *rest))
    rows = [(0, i, 1.0 + i % 3) for i in range(1, 300)]
    panel = {(at(t), s): float(t % 7) for t in range(400) for s in (0, 5)}
    df = spark.createDataFrame([(t, s, v) for (t, s), v in panel.items()] + [(at(1), 999, 1.0)], "timestamp timestamp_ntz, sensor_id long, speed double")
    found = graph.propagate(df, edges(spark, rows), ["speed"], broadcast_rows=0, links_per_slot=100)
    close({(r["timestamp"], r["sensor_id"]): r["speed"] for r in found.collect()}, brute_propagate(rows, panel, 1))
    assert joined[0] <= 2 * 8 * 6 < 300 * 400  # blocks of sensors with values, strips of each, blocks of times


def test_blocks_treat_missing_and_undefined_values_as_rows_do(spark):
    rows = [("a", "b", 1.0), ("b", "c", 2.0), ("c", "a", 0.5), ("c", "b", -3.0), ("d", "a", 1.0)]
    links = spark.createDataFrame(rows, "source_sensor string, destination_sensor string, weight double")
    cells = [("a", 1, 1.0, None), ("b", 1, None, None), ("c", 1, 4.0, 2.0), ("d", 2, None, 3.0), ("b", 3, float("nan"), 1.0), ("a", 4, float("inf"), None), ("x", 1, 1.0, 1.0)]
    df = spark.createDataFrame(cells, "sensor_id string, timestamp int, speed double, flow float")
    by_rows, by_blocks = [graph.propagate(df, links, ["speed", "flow"], hops, broadcast_rows=n).collect() for hops, n in ((1, 100), (1, 0))]
    key = lambda r: (r["timestamp"], r["sensor_id"])
    assert len(by_rows) == len(by_blocks)
    for a, b in zip(sorted(by_rows, key=key), sorted(by_blocks, key=key)):
        assert key(a) == key(b) and [a["speed"], a["flow"]] == pytest.approx([b["speed"], b["flow"]], nan_ok=True) if None not in a else tuple(a) == tuple(b)
    none = df.limit(0)
    assert graph.propagate(none, links, ["speed"], 2, broadcast_rows=0).count() == 0
    assert graph.propagate(df, links.limit(0), ["speed"], broadcast_rows=0).count() == 0


def test_products_are_added_up_without_another_shuffle(spark, monkeypatch):
    """Many cells, some of them without a sensor, a time or a reading: each sums its own, nothing is added up behind it."""
    for name, size in (("MOST_IN_CELL", 60), ("LEAST_IN_CELL", 1), ("MOST_IN_TILE", 20), ("LINKS_PER_STRIP", 7), ("PRODUCTS", 16)):
        monkeypatch.setattr(tiles, name, size)
    plans, store = {}, tiles.stored
    monkeypatch.setattr(tiles, "stored", lambda df, name: plans.update({name: plan(df)}) or store(df, name))
    rows = [r for r in random_edges(9, 300, 25) if r[2]]
    nodes = sorted({v for s, d, _ in rows for v in (s, d)})
    panel = {(at(t), v): float((t * 7 + v * 3) % 11) for t in range(23) for v in nodes if (t * v) % 4 == 1}
    df = spark.createDataFrame([(t, v, x) for (t, v), x in panel.items()], "timestamp timestamp_ntz, sensor_id long, speed double")
    by_rows, by_blocks = [
        {(r["timestamp"], r["sensor_id"]): r["speed"] for r in graph.propagate(df, edges(spark, rows), ["speed"], broadcast_rows=n, links_per_slot=7).collect()}
        for n in (10**6, 0)
    ]
    close(by_blocks, by_rows)
    above = plans["propagated"].split("MapInArrow")[0]
    assert "Aggregate" not in above and "Exchange" not in above


def test_cells_follow_the_bytes_that_move():
    dense, sparse = tiles.layout(90_000, 720, 64_800_000, 6_000_000, 1), tiles.layout(90_000, 720, 5_700_000, 6_000_000, 1)
    assert sparse.destinations > dense.destinations and sparse.times < dense.times  # fewer readings are copied more often
    for many, times in ((540_000, 720), (1500, 260_000), (3, 10**7), (10**7, 1)):
        to = tiles.layout(many, times, many * times, 60 * many, 2)
        assert many / to.destinations * times / to.times * 2 <= 1.1 * tiles.MOST_IN_CELL


def test_hub_of_transitions_can_be_split(spark):
    """With low limits the join of a hub's links with the totals is read in split partitions."""
    rows = spark.range(60_000).select(F.lit(0).alias("source_sensor"), F.col("id").alias("destination_sensor"), F.lit(1.0).alias("weight"))
    rows = rows.union(spark.range(1, 4000).select("id", F.lit(0), F.lit(1.0)))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "1g",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = graph.transitions(rows)
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_edges_without_an_end_are_dropped(spark):
    rows = [*GOLDEN, (None, 1, 5.0), (2, None, 7.0), (None, None, 1.0)]
    found = build_graph_features(edges(spark, rows), GraphConfig(iterations=2))
    assert values(found, by=["sensor_id"]) == values(build_graph_features(edges(spark, GOLDEN), GraphConfig(iterations=2)), by=["sensor_id"])


def test_graph_features_golden(spark):
    df = build_graph_features(edges(spark, GOLDEN), GraphConfig(iterations=2))
    assert df.columns == ["sensor_id", *graph.GRAPH_DEFAULTS]
    assert values(df, "sensor_id", "pagerank", "avg_neighbor_weight", by=["sensor_id"]) == [
        (1, 0.15, 1.5), (2, 0.235, 3.0), (3, 0.801667, 0.0), (4, 1.0, 5.0)
    ]


def test_graph_features_need_their_columns(spark):
    with pytest.raises(ValueError, match="weight"):
        build_graph_features(edges(spark, GOLDEN).drop("weight"))
