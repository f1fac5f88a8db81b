"""Label dictionaries of any size against the lists that the driver holds."""

import random

import pytest

from sensorgraph.operators import encode
from tests.helpers import plan, values

R = random.Random(3)
NAMES = [f"label {k}" for k in range(60)] + [" ", "é", "LABEL 1"]
ROWS = [(k, "hot" if R.random() < 0.4 else R.choice(NAMES), None if R.random() < 0.3 else R.choice("abc"), R.randrange(200)) for k in range(900)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "k long, name string, kind string, number int").repartition(4).persist()


def ranked(column):
    counts = {}
    for row in ROWS:
        if row[column] is not None:
            counts[str(row[column])] = counts.get(str(row[column]), 0) + 1
    order = sorted(counts, key=lambda label: (-counts[label], label.encode()))
    return {label: float(i) for i, label in enumerate(order)}


COLS = {"name": 1, "kind": 2, "number": 3}


def wanted():
    index = {c: ranked(at) for c, at in COLS.items()}
    return [(row[0], *[index[c].get(str(row[at]), float(len(index[c]))) if row[at] is not None else float(len(index[c])) for c, at in COLS.items()]) for row in sorted(ROWS)]


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "hot_labels": 5}, {"broadcast_rows": 0, "hot_labels": 0}])
def test_dictionary_equals_plain_ranks(frame, options):
    indexed = encode.index_labels(frame, encode.label_dictionary(frame, list(COLS)), list(COLS), **options)
    assert indexed.columns == [*frame.columns, *[f"{c}_index" for c in COLS]]
    assert values(indexed, "k", *[f"{c}_index" for c in COLS], by=["k"]) == wanted()


@pytest.mark.parametrize("most", [10_000, 20])
def test_label_index_has_no_limit(frame, most):
    indexed = encode.label_index(frame, list(COLS), most_labels=most)
    assert values(indexed, "k", *[f"{c}_index" for c in COLS], by=["k"]) == wanted()
    wide = encode.one_hot(indexed, ["name", "kind"]).select("k", "kind", "kind_vector", "name_vector").collect()
    assert {r["name_vector"].size for r in wide} == {64} and {r["kind_vector"].size for r in wide} == {3}
    assert all(r["kind_vector"].numNonzeros() == (r["kind"] is not None) for r in wide)


def test_unseen_labels_and_columns_without_labels(spark, frame):
    dictionary = encode.label_dictionary(frame.where("name in ('hot', 'label 3')"), ["name"])
    found = encode.index_labels(frame, dictionary, ["name"], broadcast_rows=0, hot_labels=1)
    assert {(r["name"], r["name_index"]) for r in found.where("name in ('hot', 'label 3', 'label 4')").collect()} == {("hot", 0.0), ("label 3", 1.0), ("label 4", 2.0)}
    none = spark.createDataFrame([(1, None), (2, None)], "k long, name string")
    for most in (5, -1):
        assert values(encode.label_index(none, ["name"], most_labels=most), "name_index", by=["k"]) == [(0.0,), (0.0,)]
    assert encode.label_index(none.limit(0), ["name"]).count() == 0


def test_rows_with_frequent_or_no_labels_are_spread(frame):
    dictionary = encode.label_dictionary(frame, ["name"])
    text = plan(encode.index_labels(frame, dictionary, ["name"], broadcast_rows=0, hot_labels=1))
    assert "__slot" in text and text.count("BroadcastHashJoin") >= 1
