import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from sensorgraph.operators import blocks, boosting, forecast, huber, panel

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def samples(spark):
    """Of three features one is mostly zero and one has few values."""
    r = np.random.default_rng(3)
    a, b, c = np.where(r.random(900) < 0.8, 0, r.random(900) * 9), r.integers(0, 5, 900), r.random(900)
    rows = np.column_stack([a, b, c, a * b + 3 * c + r.random(900)])
    return spark.createDataFrame(rows.tolist(), "a double, b double, c double, actual double").repartition(3).localCheckpoint()


@pytest.mark.parametrize("rows", [100, blocks.ROWS_PER_BLOCK])
def test_trees_are_those_of_spark_without_its_rows_in_memory(spark, samples, monkeypatch, rows):
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", rows)
    theirs = GBTRegressor(maxIter=20, maxDepth=5, seed=7, featuresCol="x", labelCol="actual", predictionCol="wanted")
    wanted = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="x"), theirs]).fit(samples)
    monkeypatch.setattr(GBTRegressor, "_fit", lambda *a: pytest.fail("Spark keeps all rows as objects"))
    found = forecast.fit_forecaster(samples, NAMES, "gbt")
    both = wanted.transform(found.transform(samples).drop("x"))
    assert both.agg(F.max(F.abs(F.col("wanted") - F.col("predicted")))).first()[0] < 1e-9
    assert [t.numNodes for t in found.stages[1].trees] == [t.numNodes for t in wanted.stages[1].trees]


def test_trees_of_one_row_of_equal_labels_and_of_missing_features(spark):
    predicted = lambda df: [r["predicted"] for r in forecast.fit_forecaster(df, ["a"], "gbt").transform(df).orderBy("k").collect()]
    kinds = "k int, a double, actual double"
    assert predicted(spark.createDataFrame([(0, 1.0, 5.0)], kinds)) == pytest.approx([5.0])
    assert predicted(spark.createDataFrame([(0, 1.0, 5.0), (1, None, 5.0)], kinds)) == pytest.approx([5.0, 5.0])
    assert predicted(spark.createDataFrame([(0, 1.0, 5.0), (1, 2.0, 5.0), (2, None, 9.0)], kinds)) == pytest.approx([5.0, 7.0, 7.0])  # as the highest
    with pytest.raises(ValueError, match="nothing"):
        predicted(spark.createDataFrame([], kinds))


def test_summaries_keep_shares(monkeypatch):
    monkeypatch.setattr(boosting, "POINTS", 50)
    r = np.random.default_rng(1)
    numbers = np.where(r.random(9000) < 0.6, 0.0, r.random(9000))
    kept = (np.zeros(0), np.zeros(0))
    for part in np.split(numbers, 9):
        kept = boosting.smaller(*(np.concatenate(p) for p in zip(kept, (part, np.ones(len(part))), strict=True)))
    assert len(kept[0]) <= 50 and kept[1].sum() == pytest.approx(9000)
    for limit in (0.0, 0.25, 0.5, 0.75):
        assert kept[1][kept[0] <= limit].sum() / 9000 == pytest.approx((numbers <= limit).mean(), abs=0.06)


@pytest.mark.parametrize("windows", [True, False])
def test_blocks_are_read_as_they_were_written(windows):
    r = np.random.default_rng(2)
    series = r.random((4, 60))
    series[series < 0.3] = np.nan
    block = np.stack([series[:, k : k + 48].reshape(-1) for k in range(12)]) if windows else r.random((12, 192))
    row = blocks.packed(block)
    assert np.array_equal(next(blocks.unpacked(iter([row]))), block, equal_nan=True)
    assert (row["numbers"][0].as_buffer().size < block.nbytes / 4) == windows
    assert np.array_equal(next(blocks.unpacked(iter([blocks.packed(block[:, :1])]))), block[:, :1], equal_nan=True)


def test_huber_fit_is_that_of_spark_in_few_passes(spark, samples, monkeypatch):
    theirs = LinearRegression(loss="huber", maxIter=200, tol=1e-12, featuresCol="x", labelCol="actual")
    wanted = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="x"), theirs]).fit(samples).stages[1]
    monkeypatch.setattr(LinearRegression, "_fit", lambda *a: pytest.fail("Spark keeps all rows as vectors"))
    passes, reduced = [], blocks.reduced
    monkeypatch.setattr(blocks, "reduced", lambda *a: passes.append(1) or reduced(*a))
    found = forecast.fit_forecaster(samples, NAMES, "huber").stages[1]
    assert len(passes) < 12
    assert list(found.coefficients) == pytest.approx(list(wanted.coefficients), abs=1e-3)
    assert (found.intercept, found.scale) == pytest.approx((wanted.intercept, wanted.scale), abs=1e-3)
    rows = np.array(samples.select(*NAMES, "actual").collect())
    loss = lambda m: huber.objective(rows[:, 3] - rows[:, :3] @ m.coefficients.toArray() - m.intercept, m.scale, 1.35)
    assert loss(found) <= loss(wanted) * (1 + 1e-6)


def test_huber_fit_of_mostly_zero_and_of_equal_labels(spark):
    """Most labels zero: the line lies on them and the scale goes towards 0."""
    r = np.random.default_rng(4)
    rows = np.column_stack([r.random((500, 2)), np.where(r.random(500) < 0.9, 0, r.random(500) * 9)])
    frame = lambda rows: spark.createDataFrame(np.asarray(rows).tolist(), "a double, b double, actual double")
    found = forecast.fit_forecaster(frame(rows), ["a", "b"], "huber").stages[1]
    assert max(map(abs, (*found.coefficients, found.intercept, found.scale))) < 1e-2
    for label in (0.0, 7.0):
        equal = frame(rows * [1, 1, 0] + [0, 0, label])
        predicted = forecast.fit_forecaster(equal, ["a", "b"], "huber").transform(equal)
        assert predicted.agg(F.max(F.abs(F.col("predicted") - label))).first()[0] < 1e-6
    with pytest.raises(ValueError, match="nothing"):
        forecast.fit_forecaster(frame(rows).limit(0), ["a", "b"], "huber")


def test_windows_are_taken_in_batches(spark):
    """Values that no number stands for stay in their windows, and windows go on over the ends of batches."""
    df = spark.range(40).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id % 20 as int)) as timestamp", "id % 20 as time_index",
        "id div 20 as node_id", "id div 20 as sensor_id", "if(id % 3 = 0, null, cast(id as string)) as speed",
    )
    usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        found = panel.sequences(df, 4, 5, target="speed")
        assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
        rows = found.orderBy("node_id", "time_index").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)
    value = lambda i: None if i % 3 == 0 else str(i)
    wanted = [(20 * n + t, [value(20 * n + t + k) for k in range(4)], value(20 * n + t + 5)) for n in range(2) for t in range(15)]
    assert [(20 * r["node_id"] + r["time_index"], r["speed_sequence"], r["target"]) for r in rows] == wanted
