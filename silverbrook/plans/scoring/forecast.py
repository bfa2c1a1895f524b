"""Demand forecast and its rolling-origin error.

Everything here works on the daily series, so its size is bounded by the calendar whatever the size of
the bookings behind it.
"""

from __future__ import annotations

import math
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...contracts import DEMAND_FORECAST, enforce
from ...session import use_checkpoints

YEARLY_ORDER, WEEKLY_ORDER = 10, 3
YEAR, WEEK = 365.25, 7.0
INTERVAL_Z = 1.2816  # central 80 %
RIDGE = 1e-3
HORIZON = 30
MIN_DAYS, CV_PERIOD, CV_HORIZON, CV_MIN_INITIAL = 60, 7, 15, 30
MODEL_NAME = "trend_seasonal"


def _cycles() -> list[tuple[float, int]]:
    return [(YEAR, k) for k in range(1, YEARLY_ORDER + 1)] + [(WEEK, k) for k in range(1, WEEKLY_ORDER + 1)]


def feature_columns(day: Column) -> dict[str, Column]:
    """Linear trend and the yearly and weekly Fourier terms of a date."""
    t = F.unix_date(day).cast("double")
    terms = {"trend": t / YEAR}
    for period, k in _cycles():
        angle = t * (2 * math.pi * k / period)
        terms[f"s{int(period)}_{k}"], terms[f"c{int(period)}_{k}"] = F.sin(angle), F.cos(angle)
    return terms


def _design(series: DataFrame) -> DataFrame:
    terms = feature_columns(F.col("ds"))
    assembled = VectorAssembler(inputCols=list(terms), outputCol="features")
    return assembled.transform(series.withColumns(terms)).drop(*terms)


def fit(daily: DataFrame):
    """A ridge regression on trend and seasons of ``(ds, y)``."""
    estimator = LinearRegression(featuresCol="features", labelCol="label", regParam=RIDGE, solver="normal")
    return estimator.fit(_design(daily).withColumn("label", F.col("y").cast("double")))


def future(daily: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The dates after the series."""
    last = daily.agg(F.max("ds").alias("d"))
    days = F.sequence(F.date_add("d", 1), F.date_add("d", horizon))
    return last.filter(F.col("d").isNotNull()).select(F.explode(days).alias("ds"))


def predict(model, days: DataFrame, mape: float | None = None) -> DataFrame:
    """Forecast rows with an 80 % band from the residual deviation, nothing below zero."""
    spread = INTERVAL_Z * model.summary.rootMeanSquaredError
    scored = model.transform(_design(days))
    return enforce(
        scored.select(
            F.col("ds").alias("forecast_date"),
            F.greatest(F.col("prediction"), F.lit(0.0)).alias("predicted_bookings"),
            F.greatest(F.col("prediction") - spread, F.lit(0.0)).alias("lower_bound"),
            F.greatest(F.col("prediction") + spread, F.lit(0.0)).alias("upper_bound"),
            F.lit(mape).cast("double").alias("mape"),
            F.lit(MODEL_NAME).alias("model_name"),
        ),
        DEMAND_FORECAST,
    )


def forecast(daily: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M02 with the error of M03 attached where the series is long enough."""
    use_checkpoints(daily.sparkSession)
    daily = daily.checkpoint()
    errors = backtest(daily).agg(F.round(F.avg("mape"), 2).alias("mape")).first()
    return predict(fit(daily), future(daily, horizon), errors["mape"])


def cutoffs(
    daily: DataFrame, period: int = CV_PERIOD, horizon: int = CV_HORIZON, min_days: int = MIN_DAYS
) -> DataFrame:
    """The cut-offs of a back-test, one row each.

    They step back from the last possible one by ``period`` while at least ``max(30, n/2)`` days lie before them. A
    series shorter than ``min_days`` has none.
    """
    s = F.col("_s")
    span = daily.agg(F.struct(F.min("ds").alias("first"), F.max("ds").alias("last"), F.count(F.lit(1)).alias("n")).alias("_s"))
    last = F.date_sub(s["last"], horizon)
    first = F.date_add(s["first"], F.greatest(F.lit(CV_MIN_INITIAL), F.floor(s["n"] / 2)).cast("int"))
    steps = F.floor(F.date_diff(last, first) / period).cast("int")
    found = F.transform(F.sequence(F.lit(0), steps), lambda i: F.date_sub(last, i * period))
    usable = F.when((s["n"] >= min_days) & (last >= first), found).otherwise(F.array().cast("array<date>"))
    return span.select(F.explode(usable).alias("cutoff"))


def with_cutoffs(
    daily: DataFrame, period: int = CV_PERIOD, horizon: int = CV_HORIZON, min_days: int = MIN_DAYS
) -> DataFrame:
    """Each day copied to the cut-offs that train or test on it, to show the folds; ``grams.backtest`` copies none."""
    cuts = cutoffs(daily, period, horizon, min_days).agg(F.collect_list("cutoff")).scalar()
    return (
        daily.select("ds", F.col("y").cast("double").alias("y"), F.explode(cuts).alias("cutoff"))
        .filter(F.col("ds") <= F.date_add("cutoff", horizon))
    )


def backtest(daily: DataFrame, period: int = CV_PERIOD, horizon: int = CV_HORIZON) -> DataFrame:
    """Per cut-off, the mean absolute percentage error over the horizon after it."""
    from . import grams

    return grams.backtest(daily, period, horizon)
