"""Source, sink and contract queries: S*."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import functions as F

from .. import contracts
from ..functions import fixed_values as fixed
from ..plans import monitoring as mon
from ..plans import quality as q
from ..session import fresh_path
from ..sources import bridge, events, tables
from .base import Frames, register
from .pipeline import EVENT_ROWS

FLAT_BOOKING = """booking_id, booking_date, customer_id, customer_name, email, loyalty_tier, loyalty_points,
               pickup_location, pickup_time, drop_location, drop_time"""


def _messages(f: Frames):
    return events.to_kv(bridge.nested_events(f.spark, f.sf_dir), "booking_id")


def _decoded(f: Frames):
    good, _ = events.split_decoded(events.decode_json(_messages(f)))
    return events.flatten_booking(good)


register(
    "s02_decode_json",
    _decoded,
    f"SELECT b.{FLAT_BOOKING} FROM {EVENT_ROWS}",
)


def _json_arrays(f: Frames):
    """Events written as compressed files that each hold one JSON array, read back as rows."""
    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": ["[" + ",".join(batch["value"]) + "]"]})

    path = fresh_path(f.spark, "json-arrays")
    texts = _messages(f).select("value").mapInPandas(arrays, "value string")
    texts.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return events.flatten_booking(events.read_json_array(f.spark, path))


register("s03_read_json_array", _json_arrays, f"SELECT b.{FLAT_BOOKING} FROM {EVENT_ROWS}")


def _published(f: Frames, frame, label: str, **options) -> str:
    path = fresh_path(f.spark, label)
    tables.publish(f.spark, frame, path, **options)
    return path


register(
    "s04_read_table",
    lambda f: tables.read_table(f.spark, _published(f, f.customer, "customer")),
    "SELECT * FROM f_customer",
)


def _partitioned(f: Frames):
    path = fresh_path(f.spark, "booking")
    tables.write_partitioned(f.booking, path, ["booking_year", "booking_month"], mode="overwrite")
    return tables.read_table(f.spark, path).groupBy("booking_year", "booking_month").agg(
        F.count(F.lit(1)).alias("n"), F.min("booking_date").alias("first_day")
    )


register(
    "s06_partitioned_write",
    _partitioned,
    """SELECT booking_year, booking_month, count(*) AS n, min(booking_date) AS first_day FROM f_booking GROUP BY 1, 2""",
)


def _created_then_updated(f: Frames):
    """Two runs over the same payments: the first creates, the second changes nothing."""
    path = fresh_path(f.spark, "payments")
    for _ in range(2):
        tables.upsert(f.spark, f.payments, path, ["payment_id"])
    return tables.read_table(f.spark, path)


register("s07_create_or_upsert", _created_then_updated, "SELECT * FROM f_payments")
register(
    "s09_projected_read",
    lambda f: tables.read_table(
        f.spark,
        _published(f, f.mart, "serving", plain=contracts.SERVING_PLAIN),
        columns=["booking_date", "payment_amount", "booking_id", "model"],
    ),
    "SELECT booking_date, payment_amount, booking_id, model FROM f_serving",
)
register(
    "s10_keyed_messages",
    lambda f: events.to_kv(f.booking.select("booking_id", "customer_id", "pickup_hour", "route"), "booking_id"),
    """SELECT booking_id AS key, '{"booking_id":"' || booking_id || '","customer_id":"' || customer_id
              || '","pickup_hour":' || CAST(pickup_hour AS VARCHAR) || ',"route":"' || route || '"}' AS value
       FROM f_booking""",
)


def _exists(f: Frames):
    path = fresh_path(f.spark, "probe")
    before = tables.table_exists(f.spark, path)
    tables.publish(f.spark, f.customer, path)
    after = tables.table_exists(f.spark, path)
    return tables.read_table(f.spark, path).agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(before).alias("before"), F.lit(after).alias("after")
    )


register("s11_table_exists", _exists, "SELECT count(*) AS n, FALSE AS before, TRUE AS after FROM f_customer")


def _appended_alerts(f: Frames):
    path = fresh_path(f.spark, "alerts")
    for alerts in (mon.sla_breaches(f.stats), mon.first_failures(f.stats)):
        tables.append_rows(mon.alert_rows(alerts, "booking_pipeline"), path)
    return tables.read_table(f.spark, path).select("pipeline_name", "stage_name", "error_message", "alert_type", "acknowledged")


register(
    "s12_append_logs",
    _appended_alerts,
    """SELECT 'booking_pipeline' AS pipeline_name, stage_name, 'SLA breach: ' || CAST(duration_seconds AS VARCHAR)
              || 's > 600s' AS error_message, 'DQ_WARNING' AS alert_type, FALSE AS acknowledged
       FROM f_stats WHERE duration_seconds > 600
       UNION ALL
       SELECT 'booking_pipeline', stage_name, 'Run ' || run_id || ' FAILED at: ' || stage_name, 'FAILURE', FALSE
       FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY started_at, stage_name) AS r
             FROM f_stats WHERE status = 'FAILED') WHERE r = 1""",
)


def _report(f: Frames):
    path = fresh_path(f.spark, "report")
    rules = [c for c in q.suite(q.booking_suite()) if c.type == q.NOT_NULL]
    tables.write_report(q.run_suite(f.mart, rules), path)
    names = "position int, column_name string, success boolean, element_count long, unexpected_count long"
    return f.spark.read.schema(names).json(path)


register(
    "s13_validation_report",
    _report,
    "\nUNION ALL ".join(
        f"""SELECT {c.position} AS position, '{c.column}' AS column_name, count({c.column}) = count(*) AS success,
                   count(*) AS element_count, count(*) - count({c.column}) AS unexpected_count FROM f_serving"""
        for c in q.suite(q.booking_suite())
        if c.type == q.NOT_NULL
    ),
)


def _replaced_slice(f: Frames):
    """Scores of two models; the second run replaces the slice of one model only."""
    path = fresh_path(f.spark, "scores")
    scores = f.churn.select("customer_id", "churn_probability")
    both = scores.withColumn("model_name", F.explode(F.array(F.lit("first"), F.lit("second"))))
    tables.replace_slice(both, path, "model_name")
    again = scores.withColumns({"churn_probability": F.lit(1.0), "model_name": F.lit("second")})
    tables.replace_slice(again, path, "model_name")
    return tables.read_table(f.spark, path)


register(
    "s14_replace_slice",
    _replaced_slice,
    """SELECT customer_id, churn_probability, 'first' AS model_name FROM f_churn
       UNION ALL SELECT customer_id, CAST(1.0 AS DOUBLE), 'second' FROM f_churn""",
)


def _appended_once(f: Frames):
    """The failed runs are logged, then all runs: only the missing ones are added."""
    path = fresh_path(f.spark, "runs")
    runs = f.results.select("run_identifier", "success_rate", "validation_status")
    tables.append_if_absent(f.spark, runs.filter("validation_status = 'FAILED'"), path, "run_identifier")
    tables.append_if_absent(f.spark, runs.withColumn("success_rate", F.lit(0.0)), path, "run_identifier")
    return tables.read_table(f.spark, path)


register(
    "s15_append_if_absent",
    _appended_once,
    """SELECT run_identifier, CASE WHEN validation_status = 'FAILED' THEN success_rate ELSE 0.0 END AS success_rate,
              validation_status FROM f_results""",
)


def _reloaded_codes(f: Frames):
    """A fitted encoder saved by version and as latest; the latest one encodes all payments."""
    root = fresh_path(f.spark, "models")
    payments = f.payments.select("payment_id", "payment_method")
    encoder = StringIndexer(inputCol="payment_method", outputCol="code", stringOrderType="alphabetAsc")
    saved = tables.save_model(encoder.fit(payments), root, "codes", "v1")
    coded = StringIndexerModel.load(saved[-1]).transform(payments)
    return coded.select("payment_id", "payment_method", F.col("code").cast("int").alias("payment_method_code"))


register(
    "s16_model_artefact",
    _reloaded_codes,
    """SELECT payment_id, payment_method,
              CAST(dense_rank() OVER (ORDER BY payment_method) - 1 AS INTEGER) AS payment_method_code FROM f_payments""",
)
register(
    "s17_contract",
    lambda f: contracts.enforce(
        f.stats.select("run_id", "stage_name", F.when(F.col("status") != "SUCCESS", F.col("status")).alias("status")),
        contracts.RUN_STATS,
    ).select("run_id", "stage_name", "status", "records_processed", "duration_seconds", "error_message"),
    """SELECT run_id, stage_name, status, 0 AS records_processed, 0 AS duration_seconds,
              CAST(NULL AS VARCHAR) AS error_message FROM f_stats""",
)


def _defaulted(f: Frames):
    sparse = f.b_booking.select("booking_id", "pickup_location", F.col("drop_time").alias("return_date"))
    number = F.substr("booking_id", F.lit(2)).cast("long")
    derived = {"payment_id": F.format_string("PAY%06d", number), "car_id": F.format_string("C%03d", number % 10 + 1)}
    filled = contracts.with_defaults(sparse, {**fixed.FLAT_RECORD_DEFAULTS, **derived})
    return filled.select(
        "booking_id", "pickup_location", "return_date", "status", "rental_days", "price_per_day", "payment_id", "car_id"
    )


register(
    "s18_defaults",
    _defaulted,
    """SELECT booking_id, pickup_location, coalesce(drop_time, 'Unknown') AS return_date, 'confirmed' AS status,
              1 AS rental_days, CAST(0.0 AS DOUBLE) AS price_per_day,
              printf('PAY%06d', CAST(substr(booking_id, 2) AS BIGINT)) AS payment_id,
              printf('C%03d', CAST(substr(booking_id, 2) AS BIGINT) % 10 + 1) AS car_id FROM f_b_booking""",
)


def _validated(f: Frames):
    valid, rejects = contracts.split_valid(f.b_booking, ["booking_id", "drop_time"])
    marked = valid.withColumn("valid", F.lit(True)).unionByName(rejects.withColumn("valid", F.lit(False)))
    return marked.select("booking_id", "valid")


register(
    "s19_required_fields", _validated, "SELECT booking_id, coalesce(drop_time <> '', FALSE) AS valid FROM f_b_booking"
)


def _field_differences(f: Frames):
    """Fields actually present in the payment messages against the flat record contract."""
    return contracts.observed_diff(events.to_kv(f.b_payments, "booking_id"), contracts.FLAT_RECORD.struct)


register(
    "s20_schema_difference",
    _field_differences,
    "SELECT field, coalesce(messages, 0) AS messages, CASE WHEN messages IS NULL THEN 'missing' ELSE 'same' END AS change, "
    "messages IS NOT NULL AS is_compatible FROM (VALUES "
    + ", ".join(f"('{name}')" for name in contracts.FLAT_RECORD.columns)
    + """) c(field) LEFT JOIN (SELECT unnest(['booking_id', 'payment_id', 'payment_method', 'payment_amount']) AS field,
         count(*) AS messages FROM f_b_payments) USING (field)""",
)


def _typed_differences(f: Frames):
    """The payments as decoded from their messages against the flat record, types included, with the rows they hold."""
    payments = events.bronze_payments(events.split_decoded(events.decode_json(_messages(f)))[0]).drop("ingested_at")
    cast = payments.withColumn("payment_amount", F.col("payment_amount").cast("string")).withColumn("car", F.lit(1))
    rows = cast.agg(F.count(F.lit(1))).scalar()
    return contracts.schema_diff(f.spark, cast.schema, contracts.FLAT_RECORD.struct).withColumn("rows", rows)


register(
    "s20_typed_difference",
    _typed_differences,
    "SELECT field, actual_type, expected_type, CASE WHEN actual_type IS NULL THEN 'missing' WHEN expected_type IS NULL THEN 'added' "
    "WHEN actual_type <> expected_type THEN 'type_changed' ELSE 'same' END AS change, "
    "actual_type IS NOT NULL AND (expected_type IS NULL OR actual_type = expected_type) AS is_compatible, "
    "(SELECT count(*) FROM f_b_payments) AS rows FROM (VALUES "
    + ", ".join("('{}', '{}')".format(*field.split()[:2]) for field in contracts.FLAT_RECORD.ddl.split(","))
    + """) c(field, expected_type) FULL JOIN (VALUES ('booking_id', 'string'), ('payment_id', 'string'),
         ('payment_method', 'string'), ('payment_amount', 'string'), ('car', 'int')) a(field, actual_type) USING (field)""",
)
