"""Time-series and score-scaling operators on aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.measures import rows


def daily_counts(df: DataFrame, day: str = "booking_date", name: str = "y") -> DataFrame:
    """Rows per date (M01): everything after this is bounded by the calendar, not by the data."""
    return df.filter(F.col(day).isNotNull()).groupBy(F.col(day).alias("ds")).agg(rows().alias(name))


def rolling_band(
    daily: DataFrame, order_by: str = "ds", value: str = "y", size: int = 7, series: Sequence[str] = ()
) -> DataFrame:
    """Rolling mean, sample deviation, band and anomaly flag over the last ``size`` rows.

    Rows are the dates present, not calendar days, and a row lies inside its own window. The input is
    one row per date (and series), so the ordered window never sees raw rows.
    """
    window = Window.partitionBy(*series).orderBy(order_by).rowsBetween(-(size - 1), 0)
    deviation = F.coalesce(F.stddev_samp(value).over(window), F.lit(0.0))
    banded = daily.select(
        "*", F.round(F.avg(value).over(window), 6).alias("avg7"), F.round(deviation, 6).alias("std7")
    )
    upper = F.round(F.col("avg7") + 2 * F.col("std7"), 6)
    lower = F.round(F.greatest(F.col("avg7") - 2 * F.col("std7"), F.lit(0.0)), 6)
    return banded.select(
        "*",
        upper.alias("upper"),
        lower.alias("lower"),
        ((F.col(value) > upper) | (F.col(value) < lower)).alias("anomaly"),
    )


def low_volume(df: DataFrame, key: str, share: float = fixed.LOW_HOUR_SHARE) -> DataFrame:
    """Groups with fewer rows than ``share`` of the mean group."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(rows().alias("bookings"))
    mean = counted.agg(F.sum("bookings") / rows()).scalar()
    return counted.withColumn("anomaly", F.col("bookings") < mean * share)


def mean_of_last(df: DataFrame, order_by: Sequence[str], value: Column, n: int, name: str) -> DataFrame:
    """Mean over the ``n`` most recent rows (W05): top-k first, then the aggregate."""
    recent = df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n)
    return recent.agg(F.round(F.avg(value), 4).alias(name))


def min_max_risk(df: DataFrame, score: str, name: str = "fraud_risk_score") -> DataFrame:
    """Scale a score, where low means unusual, to 0-100 with the lowest at 100."""
    bounds = df.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi")).alias("b")).scalar()
    low, high = F.col("_b.lo"), F.col("_b.hi")
    scaled = (F.col(score) - high) / (low - high + 1e-9) * 100
    clipped = F.least(F.greatest(F.round(scaled, 2), F.lit(0.0)), F.lit(100.0))
    return df.withColumn("_b", bounds).withColumn(name, clipped).drop("_b")


def calendar_quantile(df: DataFrame, value: str, q: float) -> DataFrame:
    """Exact interpolated quantile of a column with a calendar-bounded domain, such as a day count.

    The aggregate keeps one entry per distinct value; for unbounded domains see ``quantile``.
    """
    return df.agg(F.percentile(value, q).alias("quantile"))
