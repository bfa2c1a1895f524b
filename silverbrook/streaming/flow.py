"""The whole way of a message in one stream: bronze slices, four silver tables, curated table.

Every batch is applied by itself. It updates the silver tables by key, and works out anew only the curated rows that it
can have changed: those of its own bookings, and those of other bookings whose customer it changed. Each step is by key
and the customers are written last, so a batch that was cut short is mended by running it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules
from ..operators.keyed import with_key_count
from ..operators.upsert import merged, unique_source
from ..plans import silver
from ..plans.curated import curate, serving_view
from ..session import Settings
from ..sources import events as ev
from ..sources.tables import read_table, replace_groups, staged, table_exists, upsert
from .ingest import BRONZE, REJECTS, _foreach, _write_slice, run_name

FLOW = "flow"
CURATED = "bookings"
KEYS = {
    "booking": ["booking_id"],
    "cars": ["booking_id", "car_id"],
    "payments": ["booking_id", "payment_id"],
    "customer": ["customer_id"],
}


def start_flow(messages: DataFrame, settings: Settings) -> StreamingQuery:
    """Messages to the curated table, up to what is available now; a restart goes on where the last run ended.

    What is no event goes to the rejects. A batch that runs again replaces its own bronze slices and leaves the keyed
    tables as they are.
    """
    checkpoint = settings.checkpoint_path(FLOW)

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_name(batch.sparkSession, checkpoint)
        good, bad = ev.split_decoded(staged(ev.decode_json(batch), "flow-batch"))
        for name, (cut, partition_by) in BRONZE.items():
            _write_slice(cut(good), settings.table_path("bronze", name), run, batch_id, partition_by)
        _write_slice(bad, settings.table_path("bronze", REJECTS), run, batch_id)
        apply_events(good, settings)

    return _foreach(messages, write, checkpoint)


def apply_events(events: DataFrame, settings: Settings) -> None:
    """Bring the silver and curated tables up to date with some events; the same events twice change nothing.

    Of several rows of a key in one batch the largest stays; a later batch replaces it. A customer without an id is
    kept with the booking alone. Every silver table is read once, and of the curated table the touched buckets.
    """
    spark = events.sparkSession
    flat = ev.flatten_booking(ev.bronze_booking(events))
    rows = {
        "booking": silver.silver_booking(flat),
        "cars": silver.silver_cars(ev.bronze_cars(events)),
        "payments": silver.silver_payments(ev.bronze_payments(events), payment_counts=False),
    }
    for name, frame in rows.items():
        upsert(spark, frame, settings.table_path("silver", name), KEYS[name])

    customers = silver.silver_customer(flat).filter(F.col("customer_id").isNotNull())
    known = _stored(spark, settings, "customer", customers)
    changed = staged(customers.exceptAll(known), "flow-customers")
    bookings = _stored(spark, settings, "booking", rows["booking"])
    moved = bookings.join(changed.select("customer_id"), "customer_id", "left_semi").select("booking_id")
    touched = staged(rows["booking"].select("booking_id").unionByName(moved).distinct(), "flow-bookings")

    def concerned(name: str) -> DataFrame:
        return _stored(spark, settings, name, rows[name]).join(touched, "booking_id", "left_semi")

    payments = with_key_count(concerned("payments"), ["booking_id"], "payment_count")
    payments = payments.withColumn("is_split_payment", rules.flag(F.col("payment_count") > 1))
    people = merged(known, changed, KEYS["customer"])
    wide = serving_view(curate(concerned("booking"), people, concerned("cars"), payments))
    replace_groups(spark, wide, settings.table_path("curated", CURATED), KEYS["booking"])
    # Last: what a customer changes is told from the table, also when the batch runs again.
    upsert(spark, unique_source(changed, KEYS["customer"]), settings.table_path("silver", "customer"), KEYS["customer"])


def curated_bookings(spark: SparkSession, settings: Settings) -> DataFrame:
    """The curated table that ``start_flow`` keeps, in the serving contract's columns."""
    return read_table(spark, settings.table_path("curated", CURATED))


def _stored(spark: SparkSession, settings: Settings, name: str, like: DataFrame) -> DataFrame:
    """A silver table in the columns of ``like``; without rows before the first batch."""
    path = settings.table_path("silver", name)
    return read_table(spark, path, columns=like.columns) if table_exists(spark, path) else like.limit(0)
