"""Query registry, shared frames, and the SQL that rebuilds those frames elsewhere."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import daily_counts
from ..plans import silver
from ..plans.curated import curate, serving_view
from ..sources import bridge

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Frames:
    """The layers of the given tables as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return bridge.table(self.spark, self.sf_dir, name)

    @cached_property
    def b_booking(self) -> DataFrame:
        return bridge.bronze_booking(self.spark, self.sf_dir)

    @cached_property
    def b_cars(self) -> DataFrame:
        return bridge.bronze_cars(self.spark, self.sf_dir)

    @cached_property
    def b_payments(self) -> DataFrame:
        return bridge.bronze_payments(self.spark, self.sf_dir)

    @cached_property
    def customer(self) -> DataFrame:
        return silver.silver_customer(self.b_booking)

    @cached_property
    def booking(self) -> DataFrame:
        return silver.silver_booking(self.b_booking)

    @cached_property
    def cars(self) -> DataFrame:
        return silver.silver_cars(self.b_cars)

    @cached_property
    def payments(self) -> DataFrame:
        return silver.silver_payments(self.b_payments)

    @cached_property
    def serving(self) -> DataFrame:
        """The serving table with all 37 columns."""
        return serving_view(curate(self.booking, self.customer, self.cars, self.payments))

    @cached_property
    def mart(self) -> DataFrame:
        """The serving table for marts that do not read the payment counts, without the join for them."""
        payments = silver.silver_payments(self.b_payments, payment_counts=False)
        return serving_view(curate(self.booking, self.customer, self.cars, payments))

    @cached_property
    def last_day(self):
        """The latest booking date, from the bookings alone: the ``as_of`` of recorded data."""
        return self.booking.agg(F.max("booking_date")).scalar()

    @cached_property
    def fraud(self) -> DataFrame:
        return bridge.fraud_scores(self.mart)

    @cached_property
    def churn(self) -> DataFrame:
        return bridge.churn_scores(self.customer)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_counts(self.mart)

    @cached_property
    def forecast(self) -> DataFrame:
        return bridge.demand_forecast(self.daily)

    @cached_property
    def stats(self) -> DataFrame:
        return bridge.run_stats(self.spark, self.sf_dir)

    @cached_property
    def alerts(self) -> DataFrame:
        return bridge.alerts(self.spark, self.sf_dir)

    @cached_property
    def results(self) -> DataFrame:
        return bridge.validation_results(self.spark, self.sf_dir)

    @cached_property
    def failed(self) -> DataFrame:
        return bridge.failed_records(self.spark, self.sf_dir)

    @cached_property
    def details(self) -> DataFrame:
        return bridge.expectation_details(self.spark, self.sf_dir)

    @cached_property
    def last_event(self):
        return self.table("events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()


def register(key: str, build: Callable[[Frames], DataFrame], sql: str | None = None) -> None:
    """Add a query under its key; ``sql`` may name any frame of ``FRAME_SQL`` as a table."""
    if key in QUERIES:
        raise ValueError(f"query {key} is registered twice")
    QUERIES[key] = lambda spark, sf_dir: build(Frames(spark, sf_dir))
    if sql is not None:
        ORACLES[key] = with_frames(sql)


def with_frames(sql: str) -> str:
    """Prefix a statement with the definitions of the frames it uses."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name, body in FRAME_SQL.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(body)
                needed[name] = body

    visit(sql)
    if not needed:
        return sql
    ordered = [n for n in FRAME_SQL if n in needed]
    frames = ",\n".join(f"{n} AS ({FRAME_SQL[n]})" for n in ordered)
    own = re.match(r"\s*WITH\s", sql)
    return f"WITH {frames},\n{sql[own.end():]}" if own else f"WITH {frames}\n{sql}"


FRAME_SQL: dict[str, str] = {
    "f_b_booking": """
SELECT 'B' || CAST(o_orderkey AS VARCHAR) AS booking_id,
       'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
       c_name AS customer_name,
       CASE WHEN c_custkey % 17 = 0 THEN lower(replace(c_name, '#', ''))
            ELSE lower(replace(c_name, '#', '')) || '@' || lower(c_mktsegment) || '.example' END AS email,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Platinum' WHEN 'BUILDING' THEN 'GOLD'
            WHEN 'FURNITURE' THEN ' silver ' WHEN 'HOUSEHOLD' THEN 'bronze' ELSE 'vip' END AS loyalty_tier,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal * 1.2) AS INTEGER) END AS loyalty_points,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS booking_date,
       n_name AS pickup_location,
       CAST(CASE WHEN o_orderkey % 12 = 0 THEN 12 ELSE o_orderkey % 12 END AS VARCHAR) || ':'
         || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')
         || CASE WHEN o_orderkey % 24 < 12 THEN ' AM' ELSE ' PM' END AS pickup_time,
       'NATION_' || CAST(o_orderkey % 25 AS VARCHAR) AS drop_location,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '6:00 PM' END AS drop_time
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "f_b_cars": """
SELECT 'B' || CAST(l_orderkey AS VARCHAR) AS booking_id,
       'K' || CAST(l_partkey AS VARCHAR) AS car_id,
       CASE p_type WHEN 'ECONOMY' THEN 'i20' WHEN 'SMALL' THEN 'Baleno' WHEN 'MEDIUM' THEN 'Nexon'
            WHEN 'STANDARD' THEN 'Creta' WHEN 'LARGE' THEN 'Thar' ELSE 'Swift' END AS model,
       p_retailprice * (1 + l_partkey % 4) AS price_per_day,
       CASE l_suppkey % 4 WHEN 0 THEN 'HDFC' WHEN 1 THEN 'ICICI' WHEN 2 THEN 'TATA AIG' ELSE 'ACME' END
         AS insurance_provider,
       CASE l_returnflag WHEN 'A' THEN ' FULL ' WHEN 'N' THEN 'Partial' ELSE 'basic' END AS insurance_coverage
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "f_b_payments": """
SELECT 'B' || CAST(l_orderkey AS VARCHAR) AS booking_id,
       'P' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
         || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-'
         || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS payment_id,
       CASE l_linenumber WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'debit_card' WHEN 3 THEN 'UPI' WHEN 4 THEN 'gpay'
            WHEN 5 THEN 'COD' WHEN 6 THEN 'Net Banking' ELSE ' PhonePe ' END AS payment_method,
       l_extendedprice / 5 AS payment_amount
FROM lineitem""",
    "f_customer": """
SELECT *, CASE WHEN email LIKE '%@%' THEN split_part(email, '@', 2) ELSE 'unknown' END AS email_domain,
       CAST(CASE loyalty_tier WHEN 'platinum' THEN 4 WHEN 'gold' THEN 3 WHEN 'silver' THEN 2 ELSE 1 END AS INTEGER)
         AS loyalty_rank,
       loyalty_tier IN ('platinum', 'gold') AS is_high_value_customer,
       CASE WHEN loyalty_points >= 10000 THEN 'platinum_range' WHEN loyalty_points >= 5000 THEN 'gold_range'
            WHEN loyalty_points >= 1000 THEN 'silver_range' ELSE 'bronze_range' END AS points_tier
FROM (SELECT DISTINCT trim(customer_id) AS customer_id, trim(customer_name) AS customer_name,
             lower(trim(email)) AS email,
             CASE WHEN lower(trim(loyalty_tier)) IN ('platinum', 'gold', 'silver', 'bronze')
                  THEN lower(trim(loyalty_tier)) ELSE 'bronze' END AS loyalty_tier,
             coalesce(loyalty_points, 0) AS loyalty_points
      FROM f_b_booking)""",
    "f_booking": """
SELECT *, CASE WHEN pickup_hour >= 0 AND pickup_hour < 6 THEN 'late_night'
               WHEN pickup_hour >= 6 AND pickup_hour < 12 THEN 'morning'
               WHEN pickup_hour >= 12 AND pickup_hour < 18 THEN 'afternoon' ELSE 'evening' END AS pickup_slot,
       CASE WHEN pickup_location = drop_location THEN 'local' ELSE 'intercity' END AS trip_type,
       pickup_location || ' → ' || drop_location AS route,
       CAST(year(booking_date) AS INTEGER) AS booking_year, CAST(month(booking_date) AS INTEGER) AS booking_month
FROM (SELECT *, CASE WHEN pickup_time LIKE '%PM%' AND h <> 12 THEN h + 12
                     WHEN pickup_time LIKE '%AM%' AND h = 12 THEN 0 ELSE h END AS pickup_hour
      FROM (SELECT trim(booking_id) AS booking_id, trim(customer_id) AS customer_id,
                   TRY_CAST(booking_date AS DATE) AS booking_date, trim(pickup_location) AS pickup_location,
                   trim(pickup_time) AS pickup_time, trim(drop_location) AS drop_location,
                   trim(drop_time) AS drop_time,
                   TRY_CAST(regexp_extract(trim(pickup_time), '([0-9]+):', 1) AS INTEGER) AS h
            FROM f_b_booking))""",
    "f_cars": """
SELECT *, CASE WHEN price_per_day >= 3000 THEN 'premium' WHEN price_per_day >= 1500 THEN 'standard'
               ELSE 'economy' END AS price_tier,
       insurance_coverage = 'full' AS has_full_insurance,
       CASE WHEN insurance_provider IN ('HDFC', 'ICICI') THEN 'private_bank'
            WHEN insurance_provider = 'TATA AIG' THEN 'general_insurance' ELSE 'other' END AS insurer_type,
       CASE WHEN model = 'Thar' THEN 'adventure' WHEN model IN ('Creta', 'Nexon') THEN 'suv'
            WHEN model IN ('i20', 'Baleno') THEN 'hatchback' WHEN model = 'Venue' THEN 'compact_suv'
            ELSE 'other' END AS car_segment
FROM (SELECT trim(booking_id) AS booking_id, trim(car_id) AS car_id, trim(model) AS model,
             round(price_per_day, 2) AS price_per_day, trim(insurance_provider) AS insurance_provider,
             CASE WHEN lower(trim(insurance_coverage)) IN ('full', 'partial') THEN lower(trim(insurance_coverage))
                  ELSE 'none' END AS insurance_coverage
      FROM f_b_cars)""",
    "f_payments": """
SELECT booking_id, payment_id, payment_method, payment_amount,
       payment_method IN ('credit_card', 'debit_card', 'upi') AS is_digital_payment,
       CASE WHEN payment_amount >= 10000 THEN 'high' WHEN payment_amount >= 5000 THEN 'medium'
            ELSE 'low' END AS amount_tier,
       payment_count, payment_count > 1 AS is_split_payment
FROM (SELECT trim(booking_id) AS booking_id, trim(payment_id) AS payment_id,
             CASE WHEN lower(trim(payment_method)) IN ('credit card', 'credit_card') THEN 'credit_card'
                  WHEN lower(trim(payment_method)) IN ('debit card', 'debit_card') THEN 'debit_card'
                  WHEN lower(trim(payment_method)) IN ('upi', 'gpay', 'phonepe') THEN 'upi'
                  WHEN lower(trim(payment_method)) IN ('cash', 'cod') THEN 'cash'
                  ELSE lower(trim(payment_method)) END AS payment_method,
             round(payment_amount, 2) AS payment_amount,
             count(*) OVER (PARTITION BY booking_id) AS payment_count
      FROM f_b_payments)""",
    "f_serving": """
SELECT b.booking_id, b.customer_id, customer_name, email, loyalty_tier, loyalty_points, booking_date,
       pickup_location, pickup_time, drop_location, drop_time, pickup_hour, pickup_slot, trip_type, route,
       booking_year, booking_month, email_domain, loyalty_rank, is_high_value_customer, points_tier, car_id, model,
       price_per_day, insurance_provider, insurance_coverage, price_tier, has_full_insurance, insurer_type,
       car_segment, payment_id, payment_method, payment_amount, is_digital_payment, amount_tier, payment_count,
       is_split_payment
FROM f_booking b LEFT JOIN f_customer c ON b.customer_id = c.customer_id
LEFT JOIN f_cars k ON b.booking_id = k.booking_id LEFT JOIN f_payments p ON b.booking_id = p.booking_id""",
    "f_daily": """
SELECT booking_date AS ds, count(*) AS y FROM f_serving WHERE booking_date IS NOT NULL GROUP BY booking_date""",
    "f_fraud": """
SELECT *, CASE WHEN fraud_risk_score < 0 THEN NULL WHEN fraud_risk_score <= 25 THEN 'LOW'
               WHEN fraud_risk_score <= 50 THEN 'MEDIUM' WHEN fraud_risk_score <= 75 THEN 'HIGH'
               WHEN fraud_risk_score <= 100 THEN 'CRITICAL' END AS risk_label
FROM (SELECT *, CAST((CAST(substr(booking_id, 2) AS BIGINT) * 7919) % 10001 AS DOUBLE) / 100 AS fraud_risk_score
      FROM f_serving)""",
    "f_churn": """
SELECT *, CASE WHEN churn_probability < 0 THEN NULL WHEN churn_probability <= 0.3 THEN 'LOW'
               WHEN churn_probability <= 0.6 THEN 'MEDIUM' WHEN churn_probability <= 0.8 THEN 'HIGH'
               WHEN churn_probability <= 1.0 THEN 'CRITICAL' END AS churn_risk
FROM (SELECT customer_id, customer_name, loyalty_tier, points_tier, is_high_value_customer,
             CAST((CAST(substr(customer_id, 2) AS BIGINT) * 7919) % 1001 AS DOUBLE) / 1000 AS churn_probability,
             CAST(0.6 AS DOUBLE) + CAST(CAST(substr(customer_id, 2) AS BIGINT) % 5 AS DOUBLE) / 20.0 AS model_auc,
             DATE '2024-01-01' + CAST(CAST(substr(customer_id, 2) AS BIGINT) % 365 AS INTEGER) AS created_at
      FROM f_customer)""",
    "f_forecast": """
SELECT ds AS forecast_date, round(CAST(y * (8 + day(ds) % 5) AS DOUBLE) / 10.0, 2) AS predicted_bookings FROM f_daily""",
    "f_stats": """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id,
       CASE event_type WHEN 'view' THEN 'spark_ingest' WHEN 'click' THEN 'transform_booking'
            WHEN 'signup' THEN 'spark_merge' WHEN 'purchase' THEN 'write_postgres' ELSE 'data_validation' END
         AS stage_name,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS records_processed,
       CAST(floor(value * 10) AS INTEGER) AS duration_seconds,
       CASE WHEN event_id % 19 = 0 THEN 'FAILED' WHEN event_id % 23 = 0 THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
       ts AS started_at
FROM events""",
    "f_alerts": """
SELECT 'booking_pipeline' AS pipeline_name, 'stage_' || CAST(user_id % 7 AS VARCHAR) AS stage_name,
       'event ' || CAST(event_id AS VARCHAR) AS error_message,
       CASE event_id % 3 WHEN 0 THEN 'FAILURE' WHEN 1 THEN 'DQ_WARNING' ELSE 'SUCCESS' END AS alert_type,
       ts AS created_at
FROM events""",
    "f_results": """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_identifier, 27 AS total_expectations,
       CAST(27 - user_id % 9 AS INTEGER) AS passed_expectations, CAST(user_id % 9 AS INTEGER) AS failed_expectations,
       round(CAST((27 - user_id % 9) * 100 AS DOUBLE) / 27, 2) AS success_rate,
       CASE WHEN user_id % 9 = 0 THEN 'PASSED' ELSE 'FAILED' END AS validation_status, max(ts) AS created_at
FROM events GROUP BY user_id""",
    "f_failed": """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_identifier,
       CASE event_id % 4 WHEN 0 THEN 'expect_column_values_to_not_be_null'
            WHEN 1 THEN 'expect_column_values_to_be_unique' WHEN 2 THEN 'expect_column_values_to_be_in_set'
            ELSE 'expect_column_values_to_be_between' END AS expectation_type,
       CASE event_id % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'booking_id' WHEN 2 THEN 'payment_amount'
            WHEN 3 THEN 'car_id' ELSE 'insurance_coverage' END AS column_name,
       'reason ' || CAST(event_id % 8 AS VARCHAR) AS failed_reason,
       'B' || CAST(event_id AS VARCHAR) AS booking_id, 'Customer ' || CAST(user_id AS VARCHAR) AS customer_name,
       value AS payment_amount
FROM events""",
    "f_details": """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_identifier,
       CASE event_id % 4 WHEN 0 THEN 'expect_column_values_to_not_be_null'
            WHEN 1 THEN 'expect_column_values_to_be_unique' WHEN 2 THEN 'expect_column_values_to_be_in_set'
            ELSE 'expect_column_values_to_be_between' END AS expectation_type,
       CASE event_id % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'booking_id' WHEN 2 THEN 'payment_amount'
            WHEN 3 THEN 'car_id' ELSE 'insurance_coverage' END AS column_name,
       event_id % 6 <> 0 AS success
FROM events""",
}
