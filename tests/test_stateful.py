"""Running totals and deduplication on streams: restarts, bounded state, late messages."""

import json
from dataclasses import replace

from pyspark.sql import functions as F

from silverbrook.session import Settings
from silverbrook.sources import events, tables
from silverbrook.streaming import ingest, stateful

from .conftest import values
from .test_events import EVENT, PAYMENT


def _event(booking, day, *amounts):
    payments = [{**PAYMENT, "payment_id": f"P{booking}{i}{a}", "amount": a} for i, a in enumerate(amounts)]
    return json.dumps({**EVENT, "booking_id": booking, "booking_date": day, "payments": payments})


def _add(spark, path, texts, schema="key string, value string"):
    rows = [(t if isinstance(t, tuple) else ("k", t)) for t in texts]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_payment_counts_grow_over_batches_and_a_restart(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    batches = [
        [_event("B1", "2024-03-01", 10.0, 20.25), _event("B2", "2024-03-02", 5.0)],
        [_event("B1", "2024-03-01", 1.0), "{bad", _event("B3", "2024-03-03")],
        [_event(" B2 ", "2024-03-02", 7.5), _event("B4", "2024-03-04", 1.0, 1.0)],
    ]
    for texts in batches:
        _add(spark, source, texts)
        # Each run starts from the checkpoint of the one before.
        stateful.start_payment_counts(events.read_event_files(spark, source, 1), lake).awaitTermination()
    got = values(stateful.payment_counts(spark, lake), "booking_id", "payment_count", "is_split_payment", "total_cents")
    assert sorted(got) == [("B1", 3, True, 3125), ("B2", 2, True, 1250), ("B4", 2, True, 200)]


def test_a_batch_that_runs_again_counts_once(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    _add(spark, source, [_event("B1", "2024-03-01", 10.0)])
    stateful.start_payment_counts(events.read_event_files(spark, source), lake).awaitTermination()
    path = lake.table_path("silver", stateful.COUNTS)
    again = spark.read.parquet(path).drop("slice").collect()
    spark.createDataFrame(again, spark.read.parquet(path).drop("slice").schema).write.mode("overwrite").parquet(f"{path}/slice=0")
    assert values(stateful.payment_counts(spark, lake), "booking_id", "payment_count") == [("B1", 1)]


def _state_rows(query):
    return query.lastProgress.stateOperators[0].numRowsTotal


def test_totals_of_old_bookings_leave_the_state(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    for month in range(1, 6):
        _add(spark, source, [_event(f"B{month}-{i}", f"2024-{month:02d}-15", 1.0) for i in range(20)])
        query = stateful.start_payment_counts(events.read_event_files(spark, source, 1), lake, lifetime="40 days")
        query.awaitTermination()
    assert 20 <= _state_rows(query) <= 60
    assert stateful.payment_counts(spark, lake).count() == 100


TIMED = "key string, value string, timestamp timestamp"


def _timed(spark, path, rows):
    df = spark.createDataFrame(rows, "key string, value string, at string")
    df.select("key", "value", F.to_timestamp("at").alias("timestamp")).coalesce(1).write.mode("append").parquet(path)


def test_repeats_are_dropped_state_is_bounded_and_late_messages_are_found(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    for day in range(1, 8):
        fresh = [(f"k{day}-{i}", _event(f"B{day}-{i}", f"2024-03-{day:02d}", 5.0), f"2024-03-{day:02d} 10:00:00") for i in range(10)]
        before = [(f"k{day - 1}-{i}", _event(f"B{day - 1}-{i}", f"2024-03-{day - 1:02d}", 5.0), f"2024-03-{day:02d} 10:30:00") for i in range(10)]
        _timed(spark, source, fresh + fresh + (before if day > 1 else []))
        run = stateful.start_deduplicated(events.read_event_files(spark, source, 1, timed=True), lake, delay="2 days")
        ingest.finish(run)
    assert _state_rows(run[stateful.ACCEPTED]) <= 60
    booking = tables.read_table(spark, lake.table_path("bronze", "booking"))
    assert booking.count() == 70 and booking.select("booking_id").distinct().count() == 70
    assert tables.read_table(spark, lake.table_path("bronze", "payments")).count() == 70
    assert stateful.late_messages(spark, lake).count() == 0
    late = ("late", _event("LATE", "2024-03-01", 5.0), "2024-03-01 10:00:00")
    _timed(spark, source, [late, late])
    ingest.finish(stateful.start_deduplicated(events.read_event_files(spark, source, 1, timed=True), lake, delay="2 days"))
    assert tables.read_table(spark, lake.table_path("bronze", "booking")).count() == 70
    assert values(stateful.late_messages(spark, lake), "key") == [("late",)]


def test_identity_is_the_offset_where_the_source_has_one(spark):
    rows = [("k", "v", "t", 0, 1), ("k", "v", "t", 0, 2), ("k", "v", "t", 0, 1)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long")
    assert len({r[0] for r in df.select(stateful.message_id(df)).collect()}) == 2
    assert len({r[0] for r in df.select(stateful.message_id(df.drop("offset"))).collect()}) == 1


def test_a_deduplicated_batch_writes_a_file_a_day(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    rows = [(f"k{i}", _event(f"B{i}", f"2024-03-{1 + i % 4:02d}", 5.0), "2024-03-05 10:00:00") for i in range(200)]
    _timed(spark, source, rows)
    ingest.finish(stateful.start_deduplicated(events.read_event_files(spark, source, 1, timed=True), lake))
    booking = tables.read_table(spark, lake.table_path("bronze", "booking"))
    assert booking.count() == 200 and len(booking.inputFiles()) == 4
