"""Linear temperature model: one distributed aggregate, a tiny solve, column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from isobar.functions.columns import month_cos, month_name, month_sin, stable_round
from isobar.operators.ordering import split_frames

# Model inputs, smallest training set, sample size of the report.
FEATURES = ["month_sin", "month_cos", "humidity", "precipitation"]
LABEL = "temp_mean"
MIN_ROWS = 10
SAMPLE_PAIRS = 50


@dataclass
class LinearModel:
    intercept: float | None = None
    coefficients: list[float] = field(default_factory=list)
    features: list[str] = field(default_factory=list)

    def predict(self) -> Column:
        """intercept + Σ coefficient · feature; an unfitted model predicts 0."""
        if self.intercept is None:
            return F.lit(0.0)
        out = F.lit(float(self.intercept))
        for name, b in zip(self.features, self.coefficients):
            out = out + F.lit(float(b)) * F.col(name)
        return out


def features(obs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Complete rows with the four inputs and the label; all of them, no cap."""
    return obs.dropna(subset=["temp_mean", "humidity", "precipitation"]).select(
        *keep,
        month_sin("month").alias("month_sin"),
        month_cos("month").alias("month_cos"),
        "humidity",
        "precipitation",
        "temp_mean",
    )


def moments(data: DataFrame, names: Sequence[str] = FEATURES, label: str = LABEL) -> DataFrame:
    """Row count, means and covariances of inputs and label: one row.

    Covariances merge stably across partitions; raw sums of products would
    lose digits over very many rows.
    """
    cols = [*names, label]
    aggs = [F.count("*").alias("n")]
    aggs += [F.avg(c).alias(f"mean_{c}") for c in cols]
    for i, a in enumerate(cols):
        aggs += [F.covar_pop(a, b).alias(f"cov_{a}__{b}") for b in cols[i:]]
    return data.agg(*aggs)


def solve(m: Row, names: Sequence[str] = FEATURES, label: str = LABEL) -> LinearModel:
    """Least squares with intercept from one row of moments.

    A singular system falls back to the mean of the label.
    """
    if not m["n"]:
        return LinearModel()
    k = len(names)
    cov = np.empty((k, k))
    for i, a in enumerate(names):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = m[f"cov_{a}__{names[j]}"]
    xy = np.array([m[f"cov_{a}__{label}"] for a in names])
    mean = np.array([m[f"mean_{a}"] for a in names])
    if np.linalg.matrix_rank(cov, hermitian=True) < k:
        return LinearModel(m[f"mean_{label}"], [0.0] * k, list(names))
    beta = np.linalg.solve(cov, xy)
    intercept = float(m[f"mean_{label}"] - mean @ beta)
    return LinearModel(intercept, [float(b) for b in beta], list(names))


def fit(data: DataFrame, names: Sequence[str] = FEATURES, label: str = LABEL) -> LinearModel:
    return solve(moments(data, names, label).first(), names, label)


def coefficients(spark: SparkSession, model: LinearModel) -> DataFrame:
    rows = []
    if model.intercept is not None:
        rows = [("intercept", float(model.intercept)), *zip(model.features, model.coefficients)]
    schema = StructType([StructField("term", StringType()), StructField("value", DoubleType())])
    return spark.createDataFrame(rows, schema)


def predict(data: DataFrame, model: LinearModel) -> DataFrame:
    return data.withColumn("prediction", model.predict())


def metrics(
    data: DataFrame, model: LinearModel, label: str = LABEL, extra: Sequence[Column] = ()
) -> DataFrame:
    """RMSE, MAE and R² in one pass; all 0 without rows or model, R² 0 for a constant label."""
    if model.intercept is None:
        return data.agg(*[F.lit(0.0).alias(c) for c in ("rmse", "mae", "r2")], *extra)
    err = F.col(label) - model.predict()
    total = F.var_pop(label)
    r2 = F.when(total > 0, 1 - F.avg(err * err) / total)
    return data.agg(
        stable_round(F.coalesce(F.sqrt(F.avg(err * err)), F.lit(0.0)), 3).alias("rmse"),
        stable_round(F.coalesce(F.avg(F.abs(err)), F.lit(0.0)), 3).alias("mae"),
        stable_round(F.coalesce(r2, F.lit(0.0)), 3).alias("r2"),
        *extra,
    )


def importance(spark: SparkSession, model: LinearModel) -> DataFrame:
    """Share of each absolute coefficient in percent, greatest first."""
    rows = coefficients(spark, model).where(F.col("term") != "intercept")
    total = float(sum(abs(b) for b in model.coefficients))
    if total == 0:
        rows = rows.where(F.lit(False))
        total = 1.0
    return rows.select(
        F.col("term").alias("feature"),
        stable_round("value", 4).alias("coefficient"),
        stable_round(F.abs("value") / F.lit(total) * 100, 1).alias("importance"),
    ).orderBy(F.desc("importance"), "feature")


@dataclass
class Evaluation:
    status: str
    model: LinearModel
    summary: DataFrame
    sample: DataFrame


def train_and_evaluate(
    obs: DataFrame, tie: Sequence[str], fraction: float = 0.8
) -> Evaluation:
    """Fit on the newest `fraction` of the rows, measure on the older rest.

    Day counts, the fit and the metrics each read their own rows: the two sides are
    bounded by date, so no row is read for both but those of the day of the cut.
    """
    train, test = split_frames(features(obs, ["observation_date", *tie]), fraction, tie)
    m = moments(train).first()
    # The test side is at most a fraction of the train side, so it is counted
    # only when the train side alone does not settle the question.
    enough = m["n"] >= MIN_ROWS or m["n"] + test.count() >= MIN_ROWS
    model = solve(m) if enough else LinearModel()
    status = "trained" if enough else "no_data"
    pairs = (
        predict(test, model)
        .orderBy(F.desc("observation_date"), *tie)
        .limit(SAMPLE_PAIRS)
        .select(
            "observation_date",
            *tie,
            stable_round(LABEL, 2).alias("actual"),
            stable_round("prediction", 2).alias("predicted"),
        )
    )
    summary = metrics(test, model, extra=[F.count("*").alias("test_size")]).select(
        F.lit(status).alias("status"),
        F.lit(m["n"]).cast("long").alias("train_size"),
        "test_size",
        "rmse",
        "mae",
        "r2",
    )
    return Evaluation(status, model, summary, pairs)


def monthly_predictions(obs: DataFrame) -> DataFrame:
    """Twelve predictions at mean humidity and rain, beside the months' actual means."""
    spark = obs.sparkSession
    m = moments(features(obs)).first()
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    if m["n"] < MIN_ROWS:
        months = months.where(F.lit(False))
    model = solve(m)
    actual = (
        obs.where(F.col(LABEL).isNotNull()).groupBy("month").agg(F.avg(LABEL).alias("actual"))
    )
    rows = months.select(
        "month",
        month_sin("month").alias("month_sin"),
        month_cos("month").alias("month_cos"),
        F.lit(m["mean_humidity"]).cast("double").alias("humidity"),
        F.lit(m["mean_precipitation"]).cast("double").alias("precipitation"),
    )
    return (
        predict(rows, model)
        .join(actual, "month", "left")
        .orderBy("month")
        .select(
            "month",
            month_name("month").alias("month_name"),
            stable_round("prediction", 1).alias("predicted"),
            stable_round(F.coalesce("actual", "prediction"), 1).alias("actual"),
        )
    )
