from pathlib import Path

from sensorgraph.operators import storage


def files(spark):
    return sorted(p.name for p in Path(storage.shared_folder(spark).removeprefix("file:")).iterdir())


def test_stored_tables_go_with_their_block(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    before = files(spark)
    with storage.temporary():
        kept = storage.stored(df, "plain")
        bucketed = storage.stored_by(df, "bucketed", ["k"])
        table = next(t.name for t in spark.catalog.listTables() if t.name.startswith("sensorgraph_bucketed"))
        assert kept.join(bucketed, "k").count() == 100
        assert len(files(spark)) == len(before) + 2
    assert files(spark) == before
    assert not spark.catalog.tableExists(table)


def test_broadcasts_are_limited_in_bytes_too(spark):
    df = spark.range(10).selectExpr("id", "repeat('x', 1000) as name")
    assert storage.fits_broadcast(df.select("id"), 10)
    assert not storage.fits_broadcast(df.select("id"), 9)
    assert not storage.fits_broadcast(df, 10)
