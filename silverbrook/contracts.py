"""Table contracts: schemas, defaults, required columns, and schema comparison."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import fixed_values as fixed

# Field names and types of the interchange records and serving tables.
EVENT_DDL = (
    "booking_id string, booking_date string, "
    "customer struct<customer_id:string,name:string,email:string,loyalty:struct<tier:string,points:int>>, "
    "booking_details struct<pickup:struct<location:string,time:string>,drop:struct<location:string,time:string>>, "
    "cars array<struct<car_id:string,model:string,price_per_day:double,features:array<string>,"
    "insurance:struct<provider:string,coverage_type:string>>>, "
    "payments array<struct<payment_id:string,method:string,amount:double>>"
)
FLAT_RECORD_DDL = (
    "booking_id string, customer_id string, customer_name string, car_id string, model string, category string, "
    "pickup_location string, drop_location string, booking_date string, return_date string, price_per_day double, "
    "rental_days int, payment_amount double, payment_method string, payment_id string, loyalty_tier string, "
    "insurance_coverage string, status string, event_timestamp string"
)
SERVING_DDL = (
    "booking_id string, customer_id string, customer_name string, email string, loyalty_tier string, "
    "loyalty_points int, booking_date date, pickup_location string, pickup_time string, drop_location string, "
    "drop_time string, pickup_hour int, pickup_slot string, trip_type string, route string, booking_year int, "
    "booking_month int, email_domain string, loyalty_rank int, is_high_value_customer boolean, points_tier string, "
    "car_id string, model string, price_per_day double, insurance_provider string, insurance_coverage string, "
    "price_tier string, has_full_insurance boolean, insurer_type string, car_segment string, payment_id string, "
    "payment_method string, payment_amount double, is_digital_payment boolean, amount_tier string, "
    "payment_count bigint, is_split_payment boolean"
)
FORECAST_DDL = (
    "forecast_date date, predicted_bookings double, lower_bound double, upper_bound double, mape double, "
    "model_name string, created_at timestamp"
)
FRAUD_DDL = (
    "booking_id string, customer_id string, customer_name string, route string, trip_type string, "
    "car_segment string, payment_amount double, payment_method string, is_digital_payment boolean, "
    "is_split_payment boolean, pickup_hour int, fraud_risk_score double, risk_label string, is_fraud int, "
    "anomaly_score double, model_name string, created_at timestamp"
)
CHURN_DDL = (
    "customer_id string, customer_name string, loyalty_tier string, points_tier string, "
    "is_high_value_customer boolean, churn_probability double, churn_risk string, model_auc double, "
    "model_name string, created_at timestamp"
)
VALIDATION_RESULTS_DDL = (
    "run_identifier string, checkpoint_name string, total_expectations int, passed_expectations int, "
    "failed_expectations int, success_rate decimal(5,2), validation_status string, validation_details string, "
    "created_at timestamp"
)
EXPECTATION_DETAILS_DDL = (
    "run_identifier string, expectation_type string, column_name string, batch_id string, success boolean, "
    "observed_value string, element_count bigint, unexpected_count bigint, unexpected_percent decimal(8,4), "
    "missing_count bigint, missing_percent decimal(8,4), unexpected_percent_total decimal(8,4), "
    "unexpected_percent_nonmissing decimal(8,4), partial_unexpected_list string, partial_unexpected_counts string, "
    "min_value string, max_value string, regex string, value_set string, created_at timestamp"
)
FAILED_RECORDS_DDL = (
    "run_identifier string, expectation_type string, column_name string, failed_reason string, failed_value string, "
    "booking_id string, customer_id string, customer_name string, email string, loyalty_tier string, "
    "loyalty_points int, booking_date date, pickup_location string, drop_location string, car_id string, "
    "model string, price_per_day double, insurance_provider string, insurance_coverage string, payment_id string, "
    "payment_method string, payment_amount double, created_at timestamp"
)
RUN_STATS_DDL = (
    "run_id string not null, stage_name string not null, records_processed int, duration_seconds int, "
    "status string, error_message string, started_at timestamp, completed_at timestamp"
)
ALERTS_DDL = (
    "pipeline_name string, stage_name string, execution_date timestamp, error_message string, alert_type string, "
    "acknowledged boolean, created_at timestamp"
)
SCHEMA_LOG_DDL = (
    "topic string, schema_version int, schema_id int, change_type string, schema_summary string, "
    "is_compatible boolean, registered_at timestamp"
)


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@dataclass(frozen=True)
class Contract:
    """A table's columns with defaults for the missing and a list of the required."""

    name: str
    ddl: str
    defaults: Mapping[str, object] = field(default_factory=dict)
    stamped: tuple[str, ...] = ()

    @property
    def struct(self) -> T.StructType:
        return schema(self.ddl)

    @property
    def columns(self) -> list[str]:
        """Names alone, readable without a session."""
        return re.findall(r"(?:^|, )(\w+) ", self.ddl)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.struct if not f.nullable]


SERVING = Contract("customer_booking_staging", SERVING_DDL)
# Ids and what goes with them: a value a customer, line or booking, so Parquet writes them without a dictionary.
SERVING_PLAIN = ("booking_id", "customer_id", "customer_name", "email", "car_id", "payment_id")
FLAT_RECORD = Contract("flat_booking", FLAT_RECORD_DDL, fixed.FLAT_RECORD_DEFAULTS)
DEMAND_FORECAST = Contract("ml_demand_forecast", FORECAST_DDL, stamped=("created_at",))
FRAUD_SCORES = Contract("ml_fraud_scores", FRAUD_DDL, stamped=("created_at",))
CHURN_SCORES = Contract("ml_churn_scores", CHURN_DDL, stamped=("created_at",))
VALIDATION_RESULTS = Contract("validation_results", VALIDATION_RESULTS_DDL, stamped=("created_at",))
EXPECTATION_DETAILS = Contract(
    "validation_expectation_details",
    EXPECTATION_DETAILS_DDL,
    {
        "element_count": 0,
        "unexpected_count": 0,
        "unexpected_percent": 0,
        "missing_count": 0,
        "missing_percent": 0,
        "unexpected_percent_total": 0,
        "unexpected_percent_nonmissing": 0,
    },
    ("created_at",),
)
FAILED_RECORDS = Contract("validation_failed_records", FAILED_RECORDS_DDL, stamped=("created_at",))
RUN_STATS = Contract(
    "pipeline_run_stats",
    RUN_STATS_DDL,
    {"records_processed": 0, "duration_seconds": 0, "status": "SUCCESS"},
    ("started_at",),
)
ALERTS = Contract("pipeline_alerts", ALERTS_DDL, {"acknowledged": False}, ("created_at",))
SCHEMA_LOG = Contract("schema_registry_log", SCHEMA_LOG_DDL, {"is_compatible": True}, ("registered_at",))

FAILED_RECORD_COLUMNS = FAILED_RECORDS.columns[5:22]


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Select, cast and default a frame into a contract; a null in a required column fails the job."""

    def column(f: T.StructField) -> Column:
        value = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in contract.stamped:
            value = F.coalesce(value, F.current_timestamp().cast(f.dataType))
        elif f.name in contract.defaults:
            value = F.coalesce(value, F.lit(contract.defaults[f.name]).cast(f.dataType))
        if not f.nullable:
            missing = F.raise_error(F.lit(f"{contract.name}.{f.name} must not be null")).cast(f.dataType)
            value = F.coalesce(value, missing)
        return value.alias(f.name)

    return df.select(*[column(f) for f in contract.struct])


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing fields (S18): a value is a constant, or a Column derived from the row's own key."""
    present = set(df.columns)
    filled = {}
    for name, value in defaults.items():
        default = value if isinstance(value, Column) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in present else default
    return df.withColumns(filled)


def complete(required: Sequence[str]) -> Column:
    """True where every required field is present and non-empty."""
    condition = F.lit(True)
    for name in required:
        condition = condition & F.coalesce(F.col(name).cast("string") != "", F.lit(False))
    return condition


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the rejects."""
    ok = complete(required)
    return df.filter(ok), df.filter(~ok)


def field_list(spark: SparkSession, struct: T.StructType) -> DataFrame:
    pairs = [(f.name, f.dataType.simpleString(), f.nullable) for f in struct]
    return spark.createDataFrame(pairs, "field string, type string, nullable boolean")


def schema_diff(spark: SparkSession, actual: T.StructType, contract: T.StructType) -> DataFrame:
    """Field-by-field comparison of a schema with a contract.

    A reader of the contract survives added fields; a missing field or a changed type breaks it.
    """
    have = field_list(spark, actual).select("field", F.col("type").alias("actual_type"))
    want = field_list(spark, contract).select("field", F.col("type").alias("expected_type"))
    change = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "added")
        .when(F.col("actual_type") != F.col("expected_type"), "type_changed")
        .otherwise("same")
    )
    return (
        have.join(want, "field", "full_outer")
        .withColumn("change", change)
        .withColumn("is_compatible", F.col("change").isin("same", "added"))
    )


def schema_log_entry(diff: DataFrame, topic: str, version: int, schema_id: int) -> DataFrame:
    """One change-log row for a comparison; ``is_compatible`` is what was found, not a constant."""
    changed = F.col("change") != "same"
    summary = F.array_join(
        F.sort_array(F.collect_list(F.when(changed, F.concat_ws(":", "change", "field")))), ", "
    )
    return enforce(
        diff.agg(
            F.lit(topic).alias("topic"),
            F.lit(version).alias("schema_version"),
            F.lit(schema_id).alias("schema_id"),
            F.when(F.max(changed), "UPDATED").otherwise("REGISTERED").alias("change_type"),
            summary.alias("schema_summary"),
            F.min("is_compatible").alias("is_compatible"),
        ),
        SCHEMA_LOG,
    )


def observed_diff(messages: DataFrame, contract: T.StructType) -> DataFrame:
    """Top-level fields found in JSON messages against a contract, with how many messages carry each."""
    found = messages.select(F.explode(F.json_object_keys(F.col("value").cast("string"))).alias("field"))
    counted = found.groupBy("field").agg(F.count(F.lit(1)).alias("messages"))
    want = messages.sparkSession.createDataFrame([(f.name,) for f in contract], "field string")
    want = want.withColumn("expected", F.lit(True))
    change = (
        F.when(F.col("messages").isNull(), "missing").when(F.col("expected").isNull(), "added").otherwise("same")
    )
    return counted.join(want, "field", "full_outer").select(
        "field",
        F.coalesce("messages", F.lit(0)).alias("messages"),
        change.alias("change"),
        (change != "missing").alias("is_compatible"),
    )
