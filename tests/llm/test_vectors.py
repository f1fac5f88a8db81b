"""Vector operators against plain versions on small, awkward tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorgraph.llm import hard_negatives, vector_codes
from tests.llm.checks import negatives_of, vector_codes as plain_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, id long, number int, score double"


def vectors(n, width, seed, clusters=6, wide=0.05):
    r = random.Random(seed)
    middles = [[r.gauss(0, 0.4) for _ in range(width)] for _ in range(clusters)]
    out = []
    for k in range(n):
        m = r.choice(middles)
        v = [float(np.float32(x + r.gauss(0, wide))) for x in m]
        out.append((k * 3 + 1001 if k % 9 else k * 3 + 200_000, r.randrange(4), v))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, 5, 6, 0.5) for i, label, v in rows], SCHEMA).repartition(3)


ODD = [
    (100, 1, None), (105, 2, [0.5] * 7 + [None]), (110, 3, [0.5] * 7 + [float("nan")]), (115, 0, [float("-inf")] + [0.0] * 7),
    (200, None, [0.25] * 8), (210, None, [-0.25] * 8), (300, 1, [0.0] * 8), (305, 2, [0.0] * 8), (310, 1, [-0.0] * 8),
    (400, 2, [0.1, -0.3] * 4), (405, 1, [0.1, -0.3] * 4), (407, 1, [0.1, -0.3] * 4), (410, 2, [0.1, -0.3] * 4), (None, 3, [0.2] * 8), (0, 3, [0.2] * 8),
]


@pytest.mark.parametrize("entries", [256, 40, 3, 1])
def test_codes_equal_plain_version(spark, entries):
    rows = vectors(300, 8, 1) + ODD
    wanted, errors, books = plain_codes(rows, entries=entries)
    found = vector_codes.compress(frame(spark, rows), entries=entries)
    assert found.books.tolist() == books
    assert {r["id"]: (list(r["code"]), r["error"]) for r in found.rows.collect()} == wanted
    by_label = {(r["label"], r["label_error"]) for r in vector_codes.label_errors(found.rows).collect()}
    assert by_label == set(errors.items())


def test_codes_of_repeated_and_no_rows(spark):
    rows = vectors(40, 4, 2)
    once = vector_codes.compress(frame(spark, rows), entries=8)
    same = vector_codes.compress(frame(spark, rows + [(10**6 + k, 1, rows[0][2]) for k in range(200)]), entries=8)
    assert len({tuple(r["code"]) for r in same.rows.where("id >= 1000000").collect()}) == 1
    assert same.rows.count() == once.rows.count() + 200
    doubled = vector_codes.compress(frame(spark, rows + rows), entries=16)
    assert doubled.rows.count() == 80 and doubled.rows.groupBy("id").agg(F.countDistinct("code").alias("n")).where("n > 1").count() == 0
    none = vector_codes.compress(frame(spark, []))
    assert none.rows.count() == 0 and none.books.size == 0
    assert vector_codes.compress(frame(spark, [(1, 1, None)])).rows.count() == 0
    with pytest.raises(ValueError):
        vector_codes.compress(frame(spark, [(1, 1, [0.5] * 8), (2, 1, [0.5] * 4)]))
    with pytest.raises(ValueError):
        vector_codes.compress(frame(spark, [(1, 1, [1e30] * 8)]))


def test_decompressed_vectors_are_near(spark):
    rows = vectors(200, 8, 3, wide=0.002)
    found = vector_codes.compress(frame(spark, rows))
    back = {r["id"]: r["vector"] for r in vector_codes.decompress(found.rows, found.books).collect()}
    assert max(math.dist(back[i], v) for i, _, v in rows) < 0.05


def test_bounds_spare_comparisons_and_change_nothing():
    r = np.random.default_rng(4)
    points = np.concatenate([r.integers(-900, 900, (1, 6)) + r.integers(-40, 40, (400, 6)) for _ in range(12)]).astype(float)
    points[:500] = points[0]  # a large group of equals
    book = points[r.choice(len(points), 64, replace=False)].copy()
    book[10] = book[3]  # equal entries: the lower index wins
    kept = vector_codes.Kept(np.zeros(len(points), np.int64), np.zeros((len(points), 0), np.int64), np.full((len(points), 1), -np.inf))
    moved, keep, compared = np.zeros(64), 8, []
    for k in range(8):
        kept, best, needed = vector_codes.reassigned(points, book, moved, kept, keep)
        far = vector_codes.squared(points, book)
        assert (kept.code == far.argmin(1)).all() and (best == far.min(1)).all()
        for row in range(0, len(points), 97):  # bounds are bounds, in order
            left = np.sqrt(np.delete(far[row], [kept.code[row], *kept.near[row]]))
            assert (np.diff(kept.lower[row]) >= 0).all() and kept.lower[row, -1] <= left.min(initial=np.inf)
            inner = kept.lower[row, :-1] < kept.lower[row, -1]  # places that were added empty have the outer bound
            assert (kept.lower[row, :-1] <= np.sqrt(far[row, kept.near[row]]))[inner].all()
        compared.append((needed > kept.near.shape[1]).mean() if k else 1.0)
        new = np.array([np.floor(points[kept.code == e].mean(0)) if (kept.code == e).any() else book[e] for e in range(64)])
        moved, book = np.sqrt(((new - book) ** 2).sum(1)), new
        keep = (8, 3, 20, 5)[k % 4]
    assert compared[-1] < 0.5


def test_kept_entries_adapt():
    assert vector_codes.adapted(16, np.array([900, 90, 8, *[0] * 14, 2]), 256) == 2  # nearly all served by few
    assert vector_codes.adapted(16, np.array([100, *[0] * 16, 900]), 256) == 32  # many had to compare all
    assert vector_codes.adapted(64, np.array([0, *[0] * 64, 10]), 256) == 64
    assert vector_codes.number_type(100, 16) is np.float64 and vector_codes.number_type(1 << 25, 16) is np.int64


@pytest.mark.parametrize("anchor_bytes,shard_rows", [(1 << 24, 1 << 15), (2500, 50)])
def test_negatives_equal_plain_version(spark, monkeypatch, anchor_bytes, shard_rows):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", shard_rows)
    rows = vectors(250, 8, 5, clusters=3, wide=0.2) + ODD
    found = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0, anchor_bytes=anchor_bytes)
    assert sorted(map(tuple, found.collect())) == negatives_of(rows, 5)


def test_negatives_with_ties_repeated_and_few_rows(spark):
    rows = [(k, k % 2, [0.5, 0.5]) for k in range(300)] + [(1000, 0, [1.0, -1.0]), (1005, 1, [1.0, -1.0])]
    mined = lambda rows: hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, mined(rows).collect())) == negatives_of(rows, 50)
    twice = [(50, 1, [1.0, 0.0]), (50, 1, [0.0, 1.0]), (3, 1, [1.0, 1.0]), (4, 0, [1.0, 1.0]), (4, 0, [1.0, 1.0])]
    assert sorted(map(tuple, mined(twice).collect())) == sorted((50, 3, rank, 4, 65536, 65536) for rank in (1, 2) for _ in range(2))
    for few in ([], [(50, 1, [1.0])], [(50, 1, [1.0]), (51, 1, [1.0])], [(50, None, [1.0]), (51, 1, [1.0])], [(50, 1, []), (1, 0, [])]):
        assert mined(few).count() == 0
    with pytest.raises(ValueError):
        mined([(50, 1, [1.0]), (51, 1, [1.0, 2.0])])


def test_threshold_stops_before_the_end():
    """Where one dimension decides, few rows are scored."""
    r = np.random.default_rng(6)
    points = np.column_stack((r.integers(0, 10_000, 20_000), r.integers(0, 3, (20_000, 3))))
    shard = hard_negatives.Shard(np.arange(20_000), np.zeros(20_000, int), points, np.float64)
    anchor, best = np.array([50.0, -1.0, 0.0, 2.0]), hard_negatives.Best(5, -np.inf, np.inf)
    assert hard_negatives.search(shard, anchor, np.ones(20_000, bool), [best]) < 2_000
    scores = points @ anchor
    assert best.scores.tolist() == sorted(scores, reverse=True)[:5]
