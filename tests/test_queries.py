"""Every named query against its SQL on the smallest tables, and the contract of the entry module."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from sensorgraph.catalog import registry
from tools.compare import rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    return db


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = database.execute(ORACLES[name])
    wanted = rows_of([d[0] for d in result.description], result.fetchall())
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry_is_the_gold_table(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 59 and df.count() > 900
