"""Headline numbers of any window from stored daily sketches (A01, A13, A19 with ``approx``).

Distinct counts do not add up over days, but sketches of them do. A table of one row a day and tier keeps exact counts
and cents, and an HLL sketch for every distinct count; it is written once, refreshed month by month, and any window of
days is answered from its few rows without the serving table. Rows it holds are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import cents, rows, true_count
from ..sources.tables import read_table, replace_slice

#: Buckets of a sketch as a power of two: a standard error of 0.8 %, at most 16 KB a sketch.
SKETCH_BITS = 14
# Distinct counts of the marts: measure and the column it counts.
DISTINCT = {"customers": "customer_id", "routes": "route", "car_segments": "car_segment", "car_models": "model"}
KEYS = ("booking_date", "loyalty_tier")
MONTH = "sketch_month"


def daily_sketches(serving: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One row a booking date and tier, null ones too: exact sums and a sketch for each distinct count."""
    return serving.groupBy(*KEYS).agg(
        rows().alias("bookings"),
        F.coalesce(F.sum(cents("payment_amount")), F.lit(0)).alias("cents"),
        F.count("payment_amount").alias("payments"),
        true_count("is_high_value_customer").alias("high_value"),
        true_count("is_digital_payment").alias("digital"),
        F.coalesce(F.sum(F.col("loyalty_points").cast("long")), F.lit(0)).alias("points"),
        F.count("loyalty_points").alias("pointed"),
        *[F.hll_sketch_agg(F.col(c), F.lit(bits)).alias(f"{m}_sketch") for m, c in DISTINCT.items()],
    )


def store(sketches: DataFrame, path: str) -> None:
    """Write sketches by month; only the months ``sketches`` holds are replaced, so a refresh needs their days alone."""
    month = F.coalesce(F.date_format("booking_date", "yyyy-MM"), F.lit("none"))
    replace_slice(sketches.withColumn(MONTH, month), path, MONTH)


def window(spark: SparkSession, path: str, days: int | None = None, as_of: Column | None = None) -> DataFrame:
    """Stored rows of all dates, or of the last ``days`` up to ``as_of``; whole months before them are not read."""
    stored = read_table(spark, path)
    if days is None:
        return stored
    first = F.date_sub(F.current_date() if as_of is None else as_of, days)
    return stored.filter((F.col(MONTH) >= F.date_format(first, "yyyy-MM")) & (F.col("booking_date") >= first))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums and distinct counts over stored rows, all together or by stored keys."""
    sums = ["bookings", "cents", "payments", "high_value", "digital", "points", "pointed"]
    return sketches.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{m}_sketch")).alias(m) for m in DISTINCT],
    )


def _money(amount: str = "cents", digits: int = 0) -> Column:
    return F.round(F.when(F.col("payments") > 0, F.col(amount) / F.lit(100.0)), digits)


def kpi_summary(sketches: DataFrame) -> DataFrame:
    """A01 from sketches."""
    return merged(sketches).select(
        F.col("bookings").alias("total_bookings"), F.col("customers").alias("total_customers"), _money().alias("total_revenue"),
        F.col("high_value").alias("high_value_customers"), F.col("digital").alias("digital_payments"),
        F.col("routes").alias("unique_routes"), "car_segments", "car_models",
    )


def overall_summary(sketches: DataFrame) -> DataFrame:
    """A19 from sketches."""
    return kpi_summary(sketches).select(
        "total_bookings", F.col("total_customers").alias("unique_customers"), "unique_routes", "total_revenue",
        "high_value_customers",
    )


def loyalty_value(sketches: DataFrame) -> DataFrame:
    """A13 from sketches."""
    points = F.round(F.when(F.col("pointed") > 0, F.col("points") / F.col("pointed")), 0)
    mean = F.round(F.when(F.col("payments") > 0, F.col("cents") / F.lit(100.0) / F.col("payments")), 0)
    return merged(sketches, ["loyalty_tier"]).select(
        "loyalty_tier", "bookings", "customers", points.alias("avg_points"), F.col("high_value").alias("high_value_count"),
        mean.alias("avg_payment"),
    )
