"""Forecasts from sequences and their error metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.operators import boosting, huber


def fit_forecaster(
    train: DataFrame, features: Sequence[str], kind: str = "huber", label: str = "actual"
) -> PipelineModel:
    """``huber``: linear regression with Huber loss; ``gbt``: gradient-boosted trees.

    Both are fitted in passes over blocks of rows (see ``huber`` and ``boosting``) and returned as Spark's own models.
    """
    regressors = {
        "huber": lambda: LinearRegression(
            loss="huber", maxIter=50, featuresCol="x", labelCol=label, predictionCol="predicted"
        ),
        "gbt": lambda: GBTRegressor(
            maxIter=20, maxDepth=5, seed=7, featuresCol="x", labelCol=label, predictionCol="predicted"
        ),
    }
    if kind not in regressors:
        raise ValueError(f"unknown forecaster {kind!r}; choose one of {', '.join(regressors)}")
    assembler = VectorAssembler(inputCols=list(features), outputCol="x", handleInvalid="keep")
    regressor = regressors[kind]()
    spark = train.sparkSession
    if kind == "huber":
        fitted = huber.fit_huber(train, features, label, regressor.getMaxIter(), regressor.getTol(), regressor.getEpsilon())
        return PipelineModel([assembler, huber.spark_model(spark, regressor, fitted)])
    rounds, depth, rate = regressor.getMaxIter(), regressor.getMaxDepth(), regressor.getStepSize()
    trees, thresholds = boosting.fit_boosted_trees(train, features, label, rounds, depth, rate)
    return PipelineModel([assembler, boosting.spark_model(spark, regressor, trees, thresholds, rate)])


def persistence(seq: DataFrame, value: str = "speed") -> DataFrame:
    """Forecast that the last value of the sequence stays."""
    return seq.select(
        "*",
        F.col("target").alias("actual"),
        F.element_at(f"{value}_sequence", -1).alias("predicted"),
    )


def regression_metrics(df: DataFrame, delta: float = 1.0) -> DataFrame:
    """RMSE, MAE and mean Huber loss of ``predicted`` against ``actual``, in one row."""
    error = F.abs(F.col("actual") - F.col("predicted"))
    huber = F.when(error <= delta, 0.5 * error * error).otherwise(delta * (error - 0.5 * delta))
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("mae"),
        F.avg(huber).alias("huber"),
    )


def actual_vs_predicted(df: DataFrame, n: int = 20, keys: Sequence[str] = ("time_index", "node_id")):
    return df.select(*keys, "actual", "predicted").orderBy(*keys).limit(n)
