"""Streams that remember: running totals by key, and messages deduplicated within a watermark.

Both keep their state in the state store of their own checkpoint, so a restart goes on where it stopped, and both are
expressions of the engine: rows are combined map-side before the state is touched, so a hot key costs one state update
a task, not one a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules
from ..operators.keyed import newest_per_key
from ..session import Settings
from ..sources import events as ev
from ..sources.tables import PACKED, staged, table_exists
from .ingest import BRONZE, REJECTS, _foreach, _write_slice, append_stream, decoded_stream, run_name

# Payments of a booking arrive within so long of its date; after that its totals leave the state.
BOOKING_LIFETIME = "400 days"
# Repeats of a message arrive within so long of each other, and messages at most so late.
REPEAT_DELAY = "2 days"
COUNTS, LANDED, ACCEPTED = "payment_counts", "landed", "messages"


# -- running totals ------------------------------------------------------------------------------------------------

def payment_totals(payments: DataFrame, lifetime: str | None = BOOKING_LIFETIME) -> DataFrame:
    """Payments and cents of each booking so far; ``payments`` is a stream of bronze payments with their booking's day.

    With a ``lifetime`` the day is an event time: a booking's totals leave the state once the stream is that far past
    its day, so the state holds the bookings of one lifetime and not those of all time. Later payments of it are then
    left out. Without one all bookings stay.
    """
    cents = F.rint(rules.money(F.col("payment_amount")) * 100).cast("long")
    timed = payments if lifetime is None else payments.withWatermark("booking_day", lifetime)
    return timed.groupBy("booking_day", F.trim("booking_id").alias("booking_id")).agg(
        F.count(F.lit(1)).alias("payment_count"), F.sum(cents).alias("total_cents")
    )


def dated_payments(events: DataFrame) -> DataFrame:
    """Bronze payments with the day of their booking as a timestamp."""
    day = rules.safe_date(F.col("booking_date")).cast("timestamp")
    return events.select(day.alias("booking_day"), "booking_id", F.explode("payments").alias("payment")).select(
        "booking_day", "booking_id", F.col("payment.amount").alias("payment_amount")
    )


def start_payment_counts(
    messages: DataFrame, settings: Settings, lifetime: str | None = BOOKING_LIFETIME
) -> StreamingQuery:
    """Keep the payment count and total of every booking from a message stream (J05 on a stream).

    Update mode: a batch emits the bookings it changed, with their totals so far. They are written as the batch's own
    slice, which the batch replaces if it runs again. ``payment_counts`` reads the newest of each booking.
    """
    path = settings.table_path("silver", COUNTS)
    totals = payment_totals(dated_payments(decoded_stream(messages)), lifetime)

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumn("batch", F.lit(batch_id).cast("bigint"))
        changed.write.options(**PACKED).mode("overwrite").parquet(f"{path}/slice={batch_id}")

    return _foreach(totals, write, settings.checkpoint_path(COUNTS), "update")


def payment_counts(spark: SparkSession, settings: Settings) -> DataFrame:
    """``booking_id, payment_count, is_split_payment, total_cents``: the newest totals of each booking."""
    changes = spark.read.parquet(settings.table_path("silver", COUNTS)).drop("slice")
    newest = newest_per_key(changes, ["booking_day", "booking_id"], ["batch"])
    # Messages of one booking carry one day; should they not, its days are added up.
    return newest.groupBy("booking_id").agg(
        F.sum("payment_count").alias("payment_count"),
        (F.sum("payment_count") > 1).alias("is_split_payment"),
        F.sum("total_cents").alias("total_cents"),
    )


# -- deduplication -------------------------------------------------------------------------------------------------

def message_id(messages: DataFrame) -> Column:
    """Topic, partition and offset where the source has them, else a digest of key and value."""
    names = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    names = names if len(names) == 3 else ["key", "value"]
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string") for c in names])), 256)


def identified(messages: DataFrame) -> DataFrame:
    """``message_id, timestamp, key, value`` of messages that carry a time."""
    return messages.select(
        message_id(messages).alias("message_id"), "timestamp", F.col("key").cast("string"), F.col("value").cast("string")
    )


def deduplicated(messages: DataFrame, delay: str = REPEAT_DELAY) -> DataFrame:
    """Each message once, however often the source repeats it within ``delay``.

    The state holds the identities of one ``delay`` and drops them as the watermark passes. Messages later than the
    watermark are no longer told apart from repeats and are left out: ``late_messages`` finds them.
    """
    return identified(messages).withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["message_id"])


def start_deduplicated(messages: DataFrame, settings: Settings, delay: str = REPEAT_DELAY) -> dict[str, StreamingQuery]:
    """Bronze from a source that repeats messages (T05): two queries off one stream.

    One appends what arrives, as it is. The other deduplicates, keeps the accepted messages, and cuts them to the
    three bronze tables and the rejects, decoding a message once. A batch that is run again replaces its own slices.
    """
    checkpoint = settings.checkpoint_path(ACCEPTED)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_name(spark, checkpoint)
        _write_slice(batch, settings.table_path("bronze", ACCEPTED), run, batch_id)
        # Read back from its slice: the state is asked once, and nothing is kept in memory.
        path = f"{settings.table_path('bronze', ACCEPTED)}/run={run}/batch={batch_id}"
        accepted = spark.read.schema(batch.schema).parquet(path)
        with adaptive(spark):
            good, bad = ev.split_decoded(staged(ev.decode_json(accepted), "accepted-batch"))
            for name, (cut, partition_by) in BRONZE.items():
                _write_slice(cut(good), settings.table_path("bronze", name), run, batch_id, partition_by)
            _write_slice(bad, settings.table_path("bronze", REJECTS), run, batch_id)

    landed = append_stream(identified(messages), settings.table_path("bronze", LANDED), settings.checkpoint_path(LANDED))
    return {LANDED: landed, ACCEPTED: _foreach(deduplicated(messages, delay), write, checkpoint)}


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for what a batch does beside the state.

    A stream with state switches it off in its session, and with it the rebalance before a partitioned write: every task
    would open a file for every day.
    """
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def late_messages(spark: SparkSession, settings: Settings) -> DataFrame:
    """Messages that arrived but were too late to be accepted, once each: rejects to look at by hand."""
    landed = spark.read.parquet(settings.table_path("bronze", LANDED))
    accepted = settings.table_path("bronze", ACCEPTED)
    if table_exists(spark, accepted):
        landed = landed.join(spark.read.parquet(accepted).select("message_id"), "message_id", "left_anti")
    return landed.dropDuplicates(["message_id"])
