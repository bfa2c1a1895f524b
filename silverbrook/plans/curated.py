"""Silver to the wide curated and serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SERVING
from ..operators.keyed import HOT_ROWS, fan_out_left_join, lookup_left_join

# Dropped before the join where present; names a table does not have are ignored.
AUDIT_COLUMNS = ("transformed_at",)
BOOKING_DROPS = ("year", "month", "transformed_at")


def curate(
    booking: DataFrame,
    customer: DataFrame,
    cars: DataFrame,
    payments: DataFrame,
    *,
    booking_grain: bool = False,
    audit: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Bookings left-joined to customer, cars and payments: a row per booking x car x payment.

    ``booking_grain=True`` sums a booking's payments first, so revenue is not repeated per car; the
    per-payment columns are then absent.
    """
    payments = payments.drop(*AUDIT_COLUMNS)
    if booking_grain:
        payments = payments.groupBy("booking_id").agg(
            F.sum(F.rint(F.col("payment_amount") * 100).cast("long")).alias("cents"),
            F.count(F.lit(1)).alias("payment_count"),
        )
        payments = payments.select(
            "booking_id",
            (F.col("cents") / 100.0).alias("payment_amount"),
            "payment_count",
            (F.col("payment_count") > 1).alias("is_split_payment"),
        )
    people = lookup_left_join(
        booking.drop(*BOOKING_DROPS), customer.drop(*AUDIT_COLUMNS), ["customer_id"], hot_rows
    )
    wide = fan_out_left_join(people, [cars.drop(*AUDIT_COLUMNS), payments], "booking_id", hot_rows)
    return wide.withColumn("merged_at", F.current_timestamp()) if audit else wide


def serving_view(curated: DataFrame) -> DataFrame:
    """The serving contract's columns, in its order."""
    curated = curated.drop("merged_at")
    return curated.select(*[c for c in SERVING.columns if c in curated.columns])
