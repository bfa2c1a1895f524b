"""Streaming queries: S01, S05, T*. Each runs bounded streams to completion and returns what they wrote."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SERVING
from ..session import Settings, fresh_path
from ..sources import bridge, events, tables
from ..streaming import flow, ingest, stateful
from .base import Frames, register
from .pipeline import EVENT_ROWS

def message_path(f: Frames) -> str:
    """The booking messages of a data set as files, written once for all streams of a query."""
    if "message_path" not in f.__dict__:
        f.message_path = fresh_path(f.spark, "messages")
        messages = events.to_kv(bridge.nested_events(f.spark, f.sf_dir), "booking_id")
        messages.write.options(**tables.PACKED).parquet(f.message_path)
    return f.message_path


def _lake(spark: SparkSession) -> Settings:
    return replace(Settings(), lake_root=fresh_path(spark, "lake"))


def _stream(f: Frames, **options) -> DataFrame:
    return events.read_event_files(f.spark, message_path(f), **options)


def _bronze(f: Frames) -> Settings:
    lake = _lake(f.spark)
    ingest.finish(ingest.start_bronze(_stream(f), lake))
    return lake


def _read(f: Frames, lake: Settings, name: str) -> DataFrame:
    return tables.read_table(f.spark, lake.table_path("bronze", name))


def _sizes(f: Frames, lake: Settings) -> DataFrame:
    parts = [
        _read(f, lake, name).agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.count_distinct("booking_id").alias("bookings")
        )
        for name in ingest.BRONZE
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SIZES_SQL = f"""
SELECT 'booking' AS name, count(*) AS n, count(DISTINCT b.booking_id) AS bookings FROM {EVENT_ROWS}
UNION ALL SELECT 'cars', count(*), count(DISTINCT booking_id) FROM f_b_cars
UNION ALL SELECT 'payments', count(*), count(DISTINCT booking_id) FROM f_b_payments"""

register("t01_three_streams", lambda f: _sizes(f, _bronze(f)), SIZES_SQL)


def _one_pass(f: Frames) -> DataFrame:
    lake = _lake(f.spark)
    ingest.start_bronze_once(_stream(f), lake).awaitTermination()
    return _sizes(f, lake)


register("t01_single_pass", _one_pass, SIZES_SQL)


def _append(f: Frames, name: str = "payments") -> DataFrame:
    """One child table as its own stream."""
    lake = _lake(f.spark)
    cut, _ = ingest.BRONZE[name]
    rows = cut(ingest.decoded_stream(_stream(f))).drop("ingested_at")
    query = ingest.append_stream(rows, lake.table_path("bronze", name), lake.checkpoint_path(name))
    ingest.finish({name: query}, timeout_seconds=3600)
    return _read(f, lake, name)


PAYMENTS_SQL = "SELECT booking_id, payment_id, payment_method, payment_amount FROM f_b_payments"
register("s05_append_sink", _append, PAYMENTS_SQL)
register("t02_bounded_run", _append, PAYMENTS_SQL)
register(
    "t03_stream_explode",
    lambda f: _append(f, "cars"),
    "SELECT booking_id, car_id, model, price_per_day, insurance_provider, insurance_coverage FROM f_b_cars",
)
register(
    "t04_stream_partitions",
    lambda f: _read(f, _bronze(f), "booking").groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n")),
    f"""SELECT year(d) AS year, month(d) AS month, day(d) AS day, count(*) AS n
        FROM (SELECT CAST(booking_date AS DATE) AS d FROM {EVENT_ROWS}) GROUP BY ALL""",
)


# A message file is written by one task, so files become more with the messages, and a batch takes more of them.
FILE_MESSAGES = 1_000_000


def _more_files(f: Frames) -> int:
    """How often the fewest files of a stream are to be taken for about as many messages as there are order lines."""
    return 1 + f.table("lineitem").count() // FILE_MESSAGES


def _replayed(f: Frames) -> DataFrame:
    """A consumer without a checkpoint starts from the earliest message again."""
    first, second = _append(f), _append(f)
    return first.agg(F.count(F.lit(1)).alias("first_run")).withColumn(
        "second_run", second.agg(F.count(F.lit(1))).scalar()
    )


register(
    "t05_replay_from_earliest", _replayed, "SELECT count(*) AS first_run, count(*) AS second_run FROM f_b_payments"
)


def _restarted(f: Frames) -> DataFrame:
    """Lost checkpoints replay everything into a keyed table, which must not change."""
    lake = _lake(f.spark)
    path = lake.table_path("silver", "payments")
    for attempt in ("a", "b"):
        ingest.start_upsert(
            ingest.silver_payments_stream(_stream(f)), path, ["payment_id"], lake.checkpoint_path(attempt)
        ).awaitTermination()
    return tables.read_table(f.spark, path)


register(
    "t06_restart_idempotence",
    _restarted,
    """SELECT booking_id, payment_id, payment_method, payment_amount, is_digital_payment, amount_tier FROM f_payments""",
)
register(
    "s01_stream_source",
    lambda f: _append(f, "booking").select("booking_id", "booking_date", "customer.customer_id"),
    f"SELECT b.booking_id, booking_date, customer_id FROM {EVENT_ROWS}",
)


def _counted(f: Frames) -> DataFrame:
    """Half of the messages in several batches, a restart from the checkpoint, then the other half.

    A booking's payments come in messages of their own, so its count grows over batches and over the restart. The
    given bookings come in no order of their dates, so none is ever too old.
    """
    lake, source, more = _lake(f.spark), fresh_path(f.spark, "messages"), _more_files(f)
    messages = f.spark.read.parquet(message_path(f))
    # So many files and no fewer, of the rows as they lie.
    rows = max(1, messages.count() // (8 * more))
    for half in (0, 1):
        part = messages.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == half)
        part.write.options(**tables.PACKED, maxRecordsPerFile=rows).mode("append").parquet(source)
        stream = events.read_event_files(f.spark, source, files_per_trigger=2 * more)
        stateful.start_payment_counts(stream, lake, lifetime=None).awaitTermination()
    return stateful.payment_counts(f.spark, lake)


register(
    "t03_stream_payment_counts",
    _counted,
    """SELECT booking_id, any_value(payment_count) AS payment_count, any_value(is_split_payment) AS is_split_payment,
              CAST(sum(CAST(round(payment_amount * 100) AS BIGINT)) AS BIGINT) AS total_cents
       FROM f_payments GROUP BY booking_id""",
)


def _deduplicated(f: Frames) -> DataFrame:
    """Every message twice, the second time in other files and batches; each booking's date is its message's time."""
    lake, source, more = _lake(f.spark), fresh_path(f.spark, "doubled"), _more_files(f)
    messages = f.spark.read.parquet(message_path(f))
    booked = F.to_timestamp(F.get_json_object("value", "$.booking_date"))
    timed = messages.withColumn("timestamp", F.coalesce(booked, F.lit("1970-01-01").cast("timestamp")))
    # As a stream brings them: a file holds messages of neighbouring days.
    ranged = timed.repartitionByRange(3 * more, "timestamp")
    ranged.write.options(**tables.PACKED).mode("append").parquet(source)
    # The repeats come in smaller files, cut from the first ones as they lie.
    again, rows = f.spark.read.schema(timed.schema).parquet(source), max(1, messages.count() // (5 * more))
    again.write.options(**tables.PACKED, maxRecordsPerFile=rows).mode("append").parquet(source)
    stream = events.read_event_files(f.spark, source, files_per_trigger=4 * more, timed=True)
    ingest.finish(stateful.start_deduplicated(stream, lake, delay="20000 days"))
    return _sizes(f, lake)


register("t05_stream_deduplicated", _deduplicated, SIZES_SQL)


# Of a car that a booking has twice the later message decides; which one that is, SQL cannot know.
BY_ARRIVAL = ("insurance_provider", "insurance_coverage", "has_full_insurance", "insurer_type")


def _flow(f: Frames) -> DataFrame:
    """Half of the messages, a restart from the checkpoint, then the other half: bookings go on growing."""
    lake, source = _lake(f.spark), fresh_path(f.spark, "messages")
    messages = f.spark.read.parquet(message_path(f))
    for half in (0, 1):
        part = messages.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == half)
        part.write.options(**tables.PACKED).mode("append").parquet(source)
        flow.start_flow(events.read_event_files(f.spark, source), lake).awaitTermination()
    return flow.curated_bookings(f.spark, lake).drop(*BY_ARRIVAL)


register(
    "t07_message_flow",
    _flow,
    f"SELECT DISTINCT {', '.join(c for c in SERVING.columns if c not in BY_ARRIVAL)} FROM f_serving",
)
