"""The given star-schema tables seen as booking events, monitoring logs and score tables.

All expressions are portable scalar SQL over the tables, so an independent engine can recompute them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


BOOKING_COLUMNS = (
    "concat('B', CAST(o_orderkey AS STRING)) AS booking_id",
    "concat('C', CAST(o_custkey AS STRING)) AS customer_id",
    "c_name AS customer_name",
    """CASE WHEN c_custkey % 17 = 0 THEN lower(replace(c_name, '#', ''))
       ELSE concat(lower(replace(c_name, '#', '')), '@', lower(c_mktsegment), '.example') END AS email""",
    """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Platinum' WHEN 'BUILDING' THEN 'GOLD'
       WHEN 'FURNITURE' THEN ' silver ' WHEN 'HOUSEHOLD' THEN 'bronze' ELSE 'vip' END AS loyalty_tier""",
    "CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal * 1.2) AS INT) END AS loyalty_points",
    "CAST(CAST(o_orderdate AS DATE) AS STRING) AS booking_date",
    "n_name AS pickup_location",
    """concat(CAST(CASE WHEN o_orderkey % 12 = 0 THEN 12 ELSE o_orderkey % 12 END AS STRING), ':',
       lpad(CAST(o_orderkey % 60 AS STRING), 2, '0'),
       CASE WHEN o_orderkey % 24 < 12 THEN ' AM' ELSE ' PM' END) AS pickup_time""",
    "concat('NATION_', CAST(o_orderkey % 25 AS STRING)) AS drop_location",
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '6:00 PM' END AS drop_time",
)


def _orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )


def bronze_booking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_customer(spark, sf_dir).selectExpr(*BOOKING_COLUMNS)


CAR_COLUMNS = (
    "concat('B', CAST(l_orderkey AS STRING)) AS booking_id",
    "concat('K', CAST(l_partkey AS STRING)) AS car_id",
    """CASE p_type WHEN 'ECONOMY' THEN 'i20' WHEN 'SMALL' THEN 'Baleno' WHEN 'MEDIUM' THEN 'Nexon'
       WHEN 'STANDARD' THEN 'Creta' WHEN 'LARGE' THEN 'Thar' ELSE 'Swift' END AS model""",
    "p_retailprice * (1 + l_partkey % 4) AS price_per_day",
    """CASE l_suppkey % 4 WHEN 0 THEN 'HDFC' WHEN 1 THEN 'ICICI' WHEN 2 THEN 'TATA AIG'
       ELSE 'ACME' END AS insurance_provider""",
    """CASE l_returnflag WHEN 'A' THEN ' FULL ' WHEN 'N' THEN 'Partial'
       ELSE 'basic' END AS insurance_coverage""",
)
PAYMENT_COLUMNS = (
    "concat('B', CAST(l_orderkey AS STRING)) AS booking_id",
    """concat('P', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING),
       '-', CAST(l_suppkey AS STRING), '-', CAST(CAST(l_quantity AS INT) AS STRING)) AS payment_id""",
    """CASE l_linenumber WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'debit_card' WHEN 3 THEN 'UPI' WHEN 4 THEN 'gpay'
       WHEN 5 THEN 'COD' WHEN 6 THEN 'Net Banking' ELSE ' PhonePe ' END AS payment_method""",
    "l_extendedprice / 5 AS payment_amount",
)


def _lines_with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return lines.join(part, lines.l_partkey == part.p_partkey, "left")


def bronze_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).selectExpr(*CAR_COLUMNS)


def bronze_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*PAYMENT_COLUMNS)


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested booking events: one event per order line, and one childless event per order without lines.

    A line becomes an event with one car and one payment, so no event grows with its order. Lines and orders meet by
    their numbers, which tell them apart as booking ids do; texts are made of a line when it has met its order.
    """
    booking = _orders_with_customer(spark, sf_dir).selectExpr("o_orderkey", *BOOKING_COLUMNS)
    lines = _lines_with_part(spark, sf_dir)
    bare = booking.join(lines.select("l_orderkey").distinct(), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    met = lines.join(booking.drop("booking_id"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    own = [c for c in booking.columns if c not in ("o_orderkey", "booking_id")]
    events = met.selectExpr(*CAR_COLUMNS, *PAYMENT_COLUMNS[1:], *own)
    events = events.unionByName(bare.drop("o_orderkey"), allowMissingColumns=True)
    return events.select(
        "booking_id",
        "booking_date",
        F.struct(
            "customer_id",
            F.col("customer_name").alias("name"),
            "email",
            F.struct(F.col("loyalty_tier").alias("tier"), F.col("loyalty_points").alias("points")).alias("loyalty"),
        ).alias("customer"),
        F.struct(
            F.struct(F.col("pickup_location").alias("location"), F.col("pickup_time").alias("time")).alias("pickup"),
            F.struct(F.col("drop_location").alias("location"), F.col("drop_time").alias("time")).alias("drop"),
        ).alias("booking_details"),
        _single_or_empty(
            "car_id",
            F.struct(
                "car_id",
                "model",
                "price_per_day",
                F.array().cast("array<string>").alias("features"),
                F.struct(
                    F.col("insurance_provider").alias("provider"), F.col("insurance_coverage").alias("coverage_type")
                ).alias("insurance"),
            ),
        ).alias("cars"),
        _single_or_empty(
            "payment_id",
            F.struct("payment_id", F.col("payment_method").alias("method"), F.col("payment_amount").alias("amount")),
        ).alias("payments"),
    )


def _single_or_empty(key: str, item):
    """The item of an event that has one; a booking without lines has neither car nor payment."""
    return F.filter(F.array(item), lambda _: F.col(key).isNotNull())


# -- monitoring logs from the events table ------------------------------------------------------------------

RUN_STATS = (
    "concat('run_', CAST(user_id AS STRING)) AS run_id",
    """CASE event_type WHEN 'view' THEN 'spark_ingest' WHEN 'click' THEN 'transform_booking'
       WHEN 'signup' THEN 'spark_merge' WHEN 'purchase' THEN 'write_postgres' ELSE 'data_validation' END AS stage_name""",
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS records_processed",
    "CAST(floor(value * 10) AS INT) AS duration_seconds",
    """CASE WHEN event_id % 19 = 0 THEN 'FAILED' WHEN event_id % 23 = 0 THEN 'SKIPPED'
       ELSE 'SUCCESS' END AS status""",
    "ts AS started_at",
)
ALERTS = (
    "'booking_pipeline' AS pipeline_name",
    "concat('stage_', CAST(user_id % 7 AS STRING)) AS stage_name",
    "concat('event ', CAST(event_id AS STRING)) AS error_message",
    """CASE event_id % 3 WHEN 0 THEN 'FAILURE' WHEN 1 THEN 'DQ_WARNING' ELSE 'SUCCESS' END AS alert_type""",
    "ts AS created_at",
)
FAILED_RECORDS = (
    "concat('run_', CAST(user_id AS STRING)) AS run_identifier",
    """CASE event_id % 4 WHEN 0 THEN 'expect_column_values_to_not_be_null'
       WHEN 1 THEN 'expect_column_values_to_be_unique' WHEN 2 THEN 'expect_column_values_to_be_in_set'
       ELSE 'expect_column_values_to_be_between' END AS expectation_type""",
    """CASE event_id % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'booking_id' WHEN 2 THEN 'payment_amount'
       WHEN 3 THEN 'car_id' ELSE 'insurance_coverage' END AS column_name""",
    "concat('reason ', CAST(event_id % 8 AS STRING)) AS failed_reason",
    "concat('B', CAST(event_id AS STRING)) AS booking_id",
    "concat('Customer ', CAST(user_id AS STRING)) AS customer_name",
    "value AS payment_amount",
)


def _utc(df: DataFrame) -> DataFrame:
    """Log times as session-zone timestamps (the session zone is UTC)."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(table(spark, sf_dir, "events")).selectExpr(*RUN_STATS)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(table(spark, sf_dir, "events")).selectExpr(*ALERTS)


def failed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*FAILED_RECORDS)


def validation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One validation run per user of the events table."""
    runs = _utc(table(spark, sf_dir, "events")).groupBy("user_id").agg(F.max("ts").alias("created_at"))
    return runs.selectExpr(
        "concat('run_', CAST(user_id AS STRING)) AS run_identifier",
        "27 AS total_expectations",
        "CAST(27 - user_id % 9 AS INT) AS passed_expectations",
        "CAST(user_id % 9 AS INT) AS failed_expectations",
        "round((27 - user_id % 9) * 100 / 27D, 2) AS success_rate",
        "CASE WHEN user_id % 9 = 0 THEN 'PASSED' ELSE 'FAILED' END AS validation_status",
        "created_at",
    )


def expectation_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One evaluated rule per event."""
    return table(spark, sf_dir, "events").selectExpr(
        FAILED_RECORDS[0], FAILED_RECORDS[1], FAILED_RECORDS[2], "event_id % 6 <> 0 AS success"
    )


# -- score tables with reproducible scores -------------------------------------------------------------------

FRAUD_SCORE = "CAST((CAST(substr(booking_id, 2) AS BIGINT) * 7919) % 10001 AS DOUBLE) / 100"
CHURN_SCORE = "CAST((CAST(substr(customer_id, 2) AS BIGINT) * 7919) % 1001 AS DOUBLE) / 1000"


def fraud_scores(serving: DataFrame) -> DataFrame:
    """A fraud score table for a serving frame: the score is a function of the booking key."""
    scored = serving.withColumn("fraud_risk_score", F.expr(FRAUD_SCORE))
    return scored.withColumn("risk_label", rules.fraud_risk_label(F.col("fraud_risk_score")))


def churn_scores(customers: DataFrame) -> DataFrame:
    """A churn score table for silver customers: the score is a function of the customer key."""
    key = F.expr("CAST(substr(customer_id, 2) AS BIGINT)")
    return customers.select(
        "customer_id",
        "customer_name",
        "loyalty_tier",
        "points_tier",
        "is_high_value_customer",
        F.expr(CHURN_SCORE).alias("churn_probability"),
        rules.churn_risk_label(F.expr(CHURN_SCORE)).alias("churn_risk"),
        (F.lit(0.6) + (key % 5) / F.lit(20.0)).alias("model_auc"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 365).cast("int")).alias("created_at"),
    )


def demand_forecast(daily: DataFrame) -> DataFrame:
    """A forecast table for a daily series ``(ds, y)``: off by a known share per day."""
    wave = F.dayofmonth("ds") % 5
    return daily.select(
        F.col("ds").alias("forecast_date"),
        F.round(F.col("y") * (F.lit(8) + wave) / F.lit(10.0), 2).alias("predicted_bookings"),
        F.lit(None).cast("double").alias("mape"),
    )
