"""Decoding, exploding and streaming."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from silverbrook.catalog import streams
from silverbrook.catalog.base import Frames
from silverbrook.plans.silver import silver_booking, silver_customer
from silverbrook.session import Settings
from silverbrook.sources import bridge, events, tables
from silverbrook.streaming import ingest

from .conftest import values

CAR = {"car_id": "K1", "model": "Thar", "price_per_day": 3000.0, "features": ["gps"],
       "insurance": {"provider": "HDFC", "coverage_type": "Full"}}
PAYMENT = {"payment_id": "P1", "method": "UPI", "amount": 5000.0}
EVENT = {
    "booking_id": "B1", "booking_date": "2024-03-01",
    "customer": {"customer_id": "C1", "name": "N", "email": "N@x.example", "loyalty": {"tier": "Gold", "points": 5000}},
    "booking_details": {"pickup": {"location": "a", "time": "3:00 PM"}, "drop": {"location": "b", "time": None}},
    "cars": [CAR, {**CAR, "car_id": "K2"}], "payments": [PAYMENT],
}


def _messages(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, value string")


def test_good_and_bad_messages(spark):
    df = _messages(
        spark, json.dumps(EVENT), "{bad", json.dumps({**EVENT, "booking_id": "B2", "cars": [{**CAR, "price_per_day": "x"}]}),
        json.dumps({**EVENT, "booking_id": "B3", "cars": []}),
        json.dumps({k: v for k, v in {**EVENT, "booking_id": "B4"}.items() if k != "payments"}),
        json.dumps({**EVENT, "booking_id": "B5", "unheard_of": 1}),
    )
    good, bad = events.split_decoded(events.decode_json(df))
    assert sorted(values(good, "booking_id")) == [("B1",), ("B3",), ("B4",), ("B5",)]
    assert bad.count() == 2
    assert sorted(values(events.bronze_cars(good), "booking_id", "car_id")) == [
        (b, k) for b in ("B1", "B4", "B5") for k in ("K1", "K2")
    ]
    assert sorted(values(events.bronze_payments(good), "booking_id")) == [("B1",), ("B3",), ("B5",)]


def test_messages_that_are_no_events_are_rejected(spark):
    rows = [("a", json.dumps(EVENT)), ("b", None), ("c", ""), ("d", "{}"), (None, json.dumps({**EVENT, "booking_id": None})), ("e", "[]")]
    df = spark.createDataFrame(rows, "key string, value string")
    good, bad = events.split_decoded(events.decode_json(df))
    assert values(good, "booking_id") == [("B1",)]
    assert bad.count() == 5 and bad.filter("value is null").count() == 0


def test_bronze_to_silver(spark):
    good, _ = events.split_decoded(events.decode_json(_messages(spark, json.dumps(EVENT))))
    bronze = events.bronze_booking(good)
    assert values(bronze, "year", "month", "day") == [(2024, 3, 1)]
    flat = events.flatten_booking(bronze)
    assert values(silver_booking(flat), "pickup_hour", "pickup_slot", "route") == [(15, "afternoon", "a → b")]
    assert values(silver_customer(flat), "email_domain", "loyalty_rank", "points_tier") == [("x.example", 3, "gold_range")]


def test_flat_record_leaves_nested_fields_empty(spark):
    good, _ = events.split_decoded(events.decode_json(_messages(spark, '{"booking_id":"B1","customer_id":"C1"}')))
    row = good.first()
    assert row["booking_id"] == "B1" and row["customer"] is None and row["cars"] is None


@pytest.mark.parametrize("content", [[EVENT, {**EVENT, "booking_id": "B2"}], EVENT])
def test_json_array_or_single_object(spark, tmp_path, content):
    (tmp_path / "bookings.json").write_text(json.dumps(content))
    ids = values(events.read_json_array(spark, str(tmp_path)), "booking_id")
    assert sorted(ids) == [("B1",), ("B2",)][: len(content) if isinstance(content, list) else 1]


def test_keyed_messages_round_trip(spark):
    df = spark.createDataFrame([("B1", 1)], "booking_id string, n int")
    assert values(events.to_kv(df, "booking_id"), "key", "value") == [("B1", '{"booking_id":"B1","n":1}')]
    assert values(events.to_kv(df, None), "key") == [(None,)]


def test_kafka_options():
    options = events.kafka_options(Settings(topic="t"))
    assert options["subscribe"] == "t" and options["failOnDataLoss"] == "false"
    assert options["startingOffsets"] == "earliest"


def test_lines_and_orders_meet_by_number(spark, folder):
    rows = {
        "orders": ([(1, 7), (1, 7), (None, 7), (2, None)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(1, 5), (3, 5), (None, 5), (1, None)], "l_orderkey long, l_partkey long"),
        "customer": ([(7, 0)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, "N")], "n_nationkey int, n_name string"),
        "part": ([(5, "SMALL", 1.0)], "p_partkey long, p_type string, p_retailprice double"),
    }
    more = {
        "orders": {"o_orderdate": "timestamp'1999-01-02'"},
        "lineitem": {
            "l_suppkey": "1L", "l_linenumber": "1", "l_quantity": "2D", "l_extendedprice": "5D", "l_returnflag": "'A'"
        },
        "customer": {"c_name": "'a'", "c_mktsegment": "'b'", "c_acctbal": "1D"},
    }
    for name, (data, ddl) in rows.items():
        added = {c: F.expr(e) for c, e in more.get(name, {}).items()}
        spark.createDataFrame(data, ddl).withColumns(added).write.parquet(f"{folder}/{name}.parquet")
    found = bridge.nested_events(spark, folder)
    got = [(r.booking_id, r.booking_date, len(r.cars), len(r.payments)) for r in found.collect()]
    day = "1999-01-02"
    assert sorted(got, key=str) == sorted(
        [("B1", day, 1, 1)] * 2 + [("B1", day, 0, 0)] * 2  # the line without a part has no car and no payment
        + [("B3", None, 1, 1), (None, None, 1, 0), (None, day, 0, 0), ("B2", day, 0, 0)],
        key=str,
    )
    assert "Join [booking_id" not in found._jdf.queryExecution().executedPlan().toString()


# -- streams ---------------------------------------------------------------------------------------------

def _write(spark, path, *ids):
    texts = [json.dumps({**EVENT, "booking_id": i, "payments": [{**PAYMENT, "payment_id": f"P{i}"}]}) for i in ids]
    _messages(spark, *texts, "{bad").write.mode("append").parquet(path)


def test_streams_equal_batch_and_resume(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    for ids in (("B1", "B2"), ("B3",)):
        _write(spark, source, *ids)
        ingest.finish(ingest.start_bronze(events.read_event_files(spark, source), lake))
    good, _ = events.split_decoded(events.decode_json(spark.read.parquet(source)))
    for name, (cut, _) in ingest.BRONZE.items():
        got = tables.read_table(spark, lake.table_path("bronze", name)).drop("ingested_at")
        want = cut(good).drop("ingested_at")
        assert got.count() == want.count()
        assert got.select(*want.columns).exceptAll(want).count() == 0


def test_streams_parse_messages_once(spark, folder, monkeypatch):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    parsed, decode = [], events.decode_json
    monkeypatch.setattr(ingest.ev, "decode_json", lambda *a, **k: parsed.append(a) or decode(*a, **k))
    spark.createDataFrame([], "key string, value string").write.parquet(source)
    for ids in ((), ("B1",), ("B2", "B3")):
        if ids:
            _write(spark, source, *ids)
        ingest.finish(ingest.start_bronze(events.read_event_files(spark, source), lake))
    assert len(parsed) == 3  # once a run, for three tables and the rejects
    sizes = {n: tables.read_table(spark, lake.table_path("bronze", n)).count() for n in (*ingest.BRONZE, "rejects")}
    assert sizes == {"booking": 3, "cars": 6, "payments": 3, "rejects": 2}


def test_single_pass_keeps_rejects(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    _write(spark, source, "B1", "B2")
    ingest.start_bronze_once(events.read_event_files(spark, source), lake).awaitTermination()
    sizes = {n: tables.read_table(spark, lake.table_path("bronze", n)).count() for n in (*ingest.BRONZE, "rejects")}
    assert sizes == {"booking": 2, "cars": 4, "payments": 2, "rejects": 1}


def test_three_streams_keep_rejects(spark, folder):
    lake, source = replace(Settings(), lake_root=f"{folder}/lake"), f"{folder}/in"
    _write(spark, source, "B1")
    ingest.finish(ingest.start_bronze(events.read_event_files(spark, source), lake))
    assert values(tables.read_table(spark, lake.table_path("bronze", "rejects")), "value") == [("{bad",)]


def test_new_checkpoint_with_other_batches_loses_and_doubles_nothing(spark, folder):
    """The checkpoint is lost twice; batches differ, and the oldest messages have gone the second time."""
    lake = replace(Settings(), lake_root=f"{folder}/lake")
    files = [f"{folder}/in{i}" for i in range(3)]
    for i, path in enumerate(files):
        spark.createDataFrame([(f"k{i}", json.dumps({**EVENT, "booking_id": f"B{i}"}))] * 2, "key string, value string").coalesce(
            1
        ).write.parquet(path)
    for life, (inputs, per_trigger) in enumerate([(files[:2], 1), (files, 64), (files[1:], 2)]):
        run = replace(lake, lake_root=lake.lake_root)
        source = f"{folder}/life{life}"
        for path in inputs:
            spark.read.parquet(path).write.mode("append").parquet(source)
        run = _other_checkpoint(run, f"{folder}/ck{life}")
        ingest.start_bronze_once(events.read_event_files(spark, source, per_trigger), run).awaitTermination()
        booking = tables.read_table(spark, lake.table_path("bronze", "booking"))
        want = 2 if life == 0 else 3
        assert sorted(values(booking, "booking_id")) == sorted((f"B{i}",) for i in range(want) for _ in range(2))
    assert {"run", "batch", "year", "month", "day"} <= set(booking.columns)


def _other_checkpoint(settings, path):
    class Moved(Settings):
        def checkpoint_path(self, name):
            return f"{path}/{name}"

    return Moved(lake_root=settings.lake_root)


def test_lost_checkpoint_changes_nothing_in_a_keyed_table(spark, folder):
    source, path = f"{folder}/in", f"{folder}/payments"
    _write(spark, source, "B1", "B2")
    for attempt in ("a", "b"):
        stream = ingest.silver_payments_stream(events.read_event_files(spark, source))
        ingest.start_upsert(stream, path, ["payment_id"], f"{folder}/ck-{attempt}").awaitTermination()
    got = tables.read_table(spark, path)
    assert sorted(values(got, "payment_id", "payment_method")) == [("PB1", "upi"), ("PB2", "upi")]


def test_stream_is_stopped_on_timeout(spark, folder):
    _write(spark, f"{folder}/in", "B1")
    stream = events.read_event_files(spark, f"{folder}/in").withColumn("n", F.length("value"))
    query = ingest.append_stream(stream, f"{folder}/out", f"{folder}/ck")
    ingest.finish({"out": query}, timeout_seconds=120)
    assert not query.isActive


def test_a_message_is_parsed_once(spark):
    good, bad = events.split_decoded(events.decode_json(_messages(spark, json.dumps(EVENT), "{bad")))
    for frame in (events.bronze_payments(good), events.bronze_booking(good), bad):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
    assert (good.count(), bad.count()) == (1, 1)


def test_the_streams_of_a_query_read_the_same_message_files(spark, sf_dir):
    frames = Frames(spark, sf_dir)
    assert streams.message_path(frames) == streams.message_path(frames)


def test_array_files_are_compressed(spark, sf_dir):
    files = entry.QUERIES["s03_read_json_array"](spark, sf_dir).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)


def test_message_files_become_more_with_the_messages(spark, sf_dir, monkeypatch):
    assert streams._more_files(Frames(spark, sf_dir)) == 1
    monkeypatch.setattr(streams, "FILE_MESSAGES", 1000)
    assert streams._more_files(Frames(spark, sf_dir)) >= 6


def test_batches_all_new_or_all_known_shuffle_no_texts(spark):
    named = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "_id string, value string")
    known = {n: spark.createDataFrame([(i,) for i in ids], "_id string") for n, ids in (("new", "c"), ("mixed", "ac"), ("old", "abc"))}
    got = {n: ingest.unknown_messages(named, k) for n, k in known.items()}
    assert {n: sorted(values(d, "_id")) for n, d in got.items()} == {
        "new": [("a",), ("a",), ("b",)], "mixed": [("b",)], "old": []
    }
    plans = {n: d._jdf.queryExecution().executedPlan().toString() for n, d in got.items()}
    assert "Join" in plans["mixed"] and "Join" not in plans["new"] + plans["old"]


def test_messages_of_bounded_streams_lie_in_several_packed_files(spark, sf_dir, monkeypatch):
    seen = []
    real = events.read_event_files

    def read(session, path, **options):
        seen.append(session.read.parquet(path).inputFiles())
        return real(session, path, **options)

    monkeypatch.setattr(events, "read_event_files", read)
    assert entry.QUERIES["t03_stream_payment_counts"](spark, sf_dir).count() > 0
    halves = len(seen[0]), len(seen[1]) - len(seen[0])
    assert min(halves) >= 4 and all(f.endswith(".zstd.parquet") for f in seen[1])
