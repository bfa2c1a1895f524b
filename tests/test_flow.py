"""Messages to the curated table: bookings grow, customers change, batches run again."""

import json
from dataclasses import replace

from silverbrook.contracts import EVENT_DDL, SERVING, schema
from silverbrook.session import Settings
from silverbrook.sources import events, tables
from silverbrook.streaming import flow

from .conftest import values


def _event(booking, customer, tier, cars=(), payments=()):
    person = {"customer_id": customer, "name": "n", "email": "a@b.example", "loyalty": {"tier": tier, "points": 10}}
    return {
        "booking_id": booking,
        "booking_date": "2024-05-06",
        "customer": person,
        "cars": [{"car_id": c, "model": "Thar", "price_per_day": 100.0} for c in cars],
        "payments": [{"payment_id": p, "method": "upi", "amount": a} for p, a in payments],
    }


def _apply(spark, settings, *made):
    frame = spark.read.schema(schema(EVENT_DDL)).json(spark.sparkContext.parallelize([json.dumps(m) for m in made]))
    flow.apply_events(frame, settings)
    return sorted(
        values(flow.curated_bookings(spark, settings), "booking_id", "loyalty_tier", "car_id", "payment_id", "payment_count"),
        key=str,
    )


def test_curated_rows_follow_later_events(spark, folder):
    settings = replace(Settings(), lake_root=folder)
    first = _apply(
        spark, settings, _event("b1", "c1", "gold"), _event("b2", "c1", "gold", ["k1"], [("p1", 5.0)]), _event("b3", None, "x")
    )
    assert first == [("b1", "gold", None, None, None), ("b2", "gold", "k1", "p1", 1), ("b3", None, None, None, None)]

    # b1 grows, which replaces its row without children; its customer's other booking follows the new tier.
    second = [_event("b1", "c1", "platinum", ["k1", "k2"], [("p2", 1.0)]), _event("b4", "c2", "silver", [], [("p3", 1.0)])]
    want = [
        ("b1", "platinum", "k1", "p2", 1),
        ("b1", "platinum", "k2", "p2", 1),
        ("b2", "platinum", "k1", "p1", 1),
        ("b3", None, None, None, None),
        ("b4", "silver", None, "p3", 1),
    ]
    assert _apply(spark, settings, *second) == want
    # The same events again, one of them twice, change nothing.
    assert _apply(spark, settings, *second, second[0]) == want
    # A second payment is counted with the stored one.
    grown = _apply(spark, settings, _event("b4", "c2", "silver", [], [("p4", 2.0)]))
    assert [r for r in grown if r[0] == "b4"] == [("b4", "silver", None, "p3", 2), ("b4", "silver", None, "p4", 2)]
    assert flow.curated_bookings(spark, settings).columns == list(SERVING.columns)


def test_a_batch_cut_short_before_the_customers_is_mended(spark, folder, monkeypatch):
    settings = replace(Settings(), lake_root=folder)
    _apply(spark, settings, _event("b1", "c1", "gold"), _event("b2", "c1", "gold"))
    calls = []

    def failing(*arguments):
        calls.append(arguments)
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(flow, "replace_groups", failing)
        try:
            _apply(spark, settings, _event("b2", "c1", "silver"))
        except OSError:
            pass
    assert calls
    again = _apply(spark, settings, _event("b2", "c1", "silver"))
    assert [r[:2] for r in again] == [("b1", "silver"), ("b2", "silver")]


def test_stream_restarts_and_keeps_rejects(spark, folder):
    settings = replace(Settings(), lake_root=f"{folder}/lake")
    for texts in (['{"booking_id": "b1", "booking_date": "2024-05-06"}', "{broken"], ['{"booking_id": "b2"}']):
        spark.createDataFrame([(None, t) for t in texts], "key string, value string").write.mode("append").parquet(f"{folder}/in")
        flow.start_flow(events.read_event_files(spark, f"{folder}/in"), settings).awaitTermination()
    assert sorted(values(flow.curated_bookings(spark, settings), "booking_id")) == [("b1",), ("b2",)]
    assert tables.read_table(spark, settings.table_path("bronze", "rejects")).count() == 1


def test_replaced_groups_lose_old_rows(spark, folder):
    path = f"{folder}/t"
    tables.replace_groups(spark, spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int"), path, ["k"])
    tables.replace_groups(spark, spark.createDataFrame([("a", 9), (None, 4)], "k string, v int"), path, ["k"])
    tables.replace_groups(spark, spark.createDataFrame([(None, 5)], "k string, v int"), path, ["k"])
    assert sorted(values(tables.read_table(spark, path), "k", "v"), key=str) == [("a", 9), ("b", 3), (None, 5)]
