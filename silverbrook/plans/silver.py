"""Bronze to silver: one cleaning plan per entity.

Inputs are the flat bronze frames (see ``sources.events.flatten_booking`` for the nested form).
``audit=False`` leaves out ``transformed_at`` where a reproducible result is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..operators.keyed import newest_per_key, with_key_count


def _audited(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn("transformed_at", F.current_timestamp()) if audit else df


def silver_customer(bronze: DataFrame, audit: bool = False) -> DataFrame:
    """One row per customer, the newest by ``ingested_at`` if the bronze frame has it."""
    stamped = ["ingested_at"] if "ingested_at" in bronze.columns else []
    picked = bronze.select(
        rules.clean(F.col("customer_id")).alias("customer_id"),
        rules.clean(F.col("customer_name")).alias("customer_name"),
        rules.clean_lower(F.col("email")).alias("email"),
        rules.clean_lower(F.col("loyalty_tier")).alias("loyalty_tier"),
        rules.safe_int(F.col("loyalty_points")).alias("loyalty_points"),
        *stamped,
    )
    unique = newest_per_key(picked, ["customer_id"], stamped).drop("ingested_at")
    tier = rules.loyalty_tier(F.col("loyalty_tier"))
    points = rules.or_zero(F.col("loyalty_points"))
    ranked = unique.select(
        "customer_id",
        "customer_name",
        "email",
        tier.alias("loyalty_tier"),
        points.alias("loyalty_points"),
        rules.email_domain(F.col("email")).alias("email_domain"),
        rules.loyalty_rank(tier).alias("loyalty_rank"),
        rules.is_high_value(rules.loyalty_rank(tier)).alias("is_high_value_customer"),
        rules.points_tier(points).alias("points_tier"),
    )
    return _audited(ranked, audit)


def silver_booking(bronze: DataFrame, audit: bool = False) -> DataFrame:
    texts = ["booking_id", "customer_id", "pickup_location", "pickup_time", "drop_location", "drop_time"]
    cleaned = bronze.select(
        *[rules.clean(F.col(c)).alias(c) for c in texts], rules.safe_date(F.col("booking_date")).alias("booking_date")
    ).withColumn("pickup_hour", rules.pickup_hour(F.col("pickup_time")))
    day, pickup, drop = F.col("booking_date"), F.col("pickup_location"), F.col("drop_location")
    enriched = cleaned.select(
        "booking_id",
        "customer_id",
        "booking_date",
        "pickup_location",
        "pickup_time",
        "drop_location",
        "drop_time",
        "pickup_hour",
        rules.pickup_slot(F.col("pickup_hour")).alias("pickup_slot"),
        rules.trip_type(pickup, drop).alias("trip_type"),
        rules.route(pickup, drop).alias("route"),
        F.year(day).alias("booking_year"),
        F.month(day).alias("booking_month"),
    )
    return _audited(enriched, audit)


def silver_cars(bronze: DataFrame, audit: bool = False) -> DataFrame:
    cleaned = bronze.select(
        *[rules.clean(F.col(c)).alias(c) for c in ("booking_id", "car_id", "model", "insurance_provider")],
        rules.money(F.col("price_per_day")).alias("price_per_day"),
        rules.insurance_coverage(rules.clean_lower(F.col("insurance_coverage"))).alias("insurance_coverage"),
    )
    enriched = cleaned.select(
        "booking_id",
        "car_id",
        "model",
        "price_per_day",
        "insurance_provider",
        "insurance_coverage",
        rules.price_tier(F.col("price_per_day")).alias("price_tier"),
        rules.has_full_insurance(F.col("insurance_coverage")).alias("has_full_insurance"),
        rules.insurer_type(F.col("insurance_provider")).alias("insurer_type"),
        rules.car_segment(F.col("model")).alias("car_segment"),
    )
    return _audited(enriched, audit)


def silver_payments(bronze: DataFrame, audit: bool = False, payment_counts: bool = True) -> DataFrame:
    """Payments with their booking's payment count.

    Counts are taken over booking ids as they arrived and matched to the trimmed ids, so an id that
    arrived padded has no count. ``payment_counts=False`` skips that join for readers without need of it.
    """
    cleaned = bronze.select(
        *[rules.clean(F.col(c)).alias(c) for c in ("booking_id", "payment_id")],
        rules.payment_method(rules.clean_lower(F.col("payment_method"))).alias("payment_method"),
        rules.money(F.col("payment_amount")).alias("payment_amount"),
    )
    columns = [
        "booking_id",
        "payment_id",
        "payment_method",
        "payment_amount",
        rules.is_digital(F.col("payment_method")).alias("is_digital_payment"),
        rules.amount_tier(F.col("payment_amount")).alias("amount_tier"),
    ]
    if payment_counts:
        cleaned = with_key_count(cleaned, ["booking_id"], "payment_count", counted=bronze)
        columns += ["payment_count", rules.flag(F.col("payment_count") > 1).alias("is_split_payment")]
    return _audited(cleaned.select(*columns), audit)
