"""Event sources and their decoding into bronze frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import EVENT_DDL, schema
from ..functions import rules
from ..session import Settings

CORRUPT = "_corrupt_record"


def kafka_options(settings: Settings) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.brokers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": "false",
        "kafka.metadata.max.age.ms": settings.metadata_max_age_ms,
        "kafka.session.timeout.ms": settings.session_timeout_ms,
    }


def read_events(spark: SparkSession, settings: Settings) -> DataFrame:
    """The subscribed topic as a stream of key/value messages (needs the Kafka package)."""
    return spark.readStream.format("kafka").options(**kafka_options(settings)).load()


def read_event_files(spark: SparkSession, path: str, files_per_trigger: int = 64, timed: bool = False) -> DataFrame:
    """Message files (``key``/``value`` Parquet) as a stream: replays from the earliest file on.

    ``timed`` files also hold each message's ``timestamp``.
    """
    return (
        spark.readStream.schema("key string, value string" + (", timestamp timestamp" if timed else ""))
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("ignoreMissingFiles", "true")
        .parquet(path)
    )


def decode_json(
    df: DataFrame, struct: T.StructType | None = None, required: tuple[str, ...] = ("booking_id",), carry: tuple[str, ...] = ()
) -> DataFrame:
    """Message value to typed columns plus ``_corrupt_record``, the text of a message that is no event.

    The reader is permissive, so a bad message is visible instead of becoming an all-null row. Besides text that
    does not fit, messages without a value, empty ones, ``{}`` and those lacking a ``required`` field are no events;
    a null value is kept as empty text. ``carry`` names columns of ``df`` to keep. A message is parsed once: a filter on
    what was parsed would go below a projection and parse again there, but not below an explode.
    """
    struct = struct or schema(EVENT_DDL)
    widened = T.StructType([*struct.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.col("value").cast("string")
    event = F.explode(F.array(F.from_json(text, widened, options))).alias("event")
    parsed = df.select(*carry, text.alias("_text"), event)
    parsed = parsed.select(*carry, "_text", "event.*")
    empty = reduce(lambda a, b: a & b, [F.col(f.name).isNull() for f in struct.fields])
    missing = [F.col(c).isNull() for c in required if c in struct.fieldNames()]
    bad = reduce(lambda a, b: a | b, missing, empty | F.col(CORRUPT).isNotNull())
    return parsed.withColumn(CORRUPT, F.when(bad, F.coalesce("_text", F.lit("")))).drop("_text")


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed events, and rejects with the offending text."""
    bad = F.col(CORRUPT).isNotNull()
    return decoded.filter(~bad).drop(CORRUPT), decoded.filter(bad).select(F.col(CORRUPT).alias("value"))


def read_json_array(spark: SparkSession, path: str, struct: T.StructType | None = None) -> DataFrame:
    """A file holding one JSON array (or one object) of events, as rows."""
    return spark.read.schema(struct or schema(EVENT_DDL)).option("multiLine", True).json(path)


def to_kv(df: DataFrame, key: str | None) -> DataFrame:
    """Rows as keyed JSON messages; no key spreads them over all partitions."""
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(key_column.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_kafka(messages: DataFrame, settings: Settings) -> None:
    """Publish keyed messages (needs the Kafka package)."""
    options = {"kafka.bootstrap.servers": settings.brokers, "topic": settings.topic, "kafka.acks": "all"}
    messages.write.format("kafka").options(**options).save()


# -- bronze ---------------------------------------------------------------------------------------------

def bronze_booking(events: DataFrame) -> DataFrame:
    day = rules.safe_date(F.col("booking_date"))
    return events.select(
        "booking_id",
        "booking_date",
        "customer",
        "booking_details",
        F.current_timestamp().alias("ingested_at"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )


def bronze_cars(events: DataFrame) -> DataFrame:
    """One row per car; an event without cars gives none."""
    return events.select("booking_id", F.explode("cars").alias("car")).select(
        "booking_id",
        "car.car_id",
        "car.model",
        "car.price_per_day",
        F.col("car.insurance.provider").alias("insurance_provider"),
        F.col("car.insurance.coverage_type").alias("insurance_coverage"),
        F.current_timestamp().alias("ingested_at"),
    )


def bronze_payments(events: DataFrame) -> DataFrame:
    """One row per payment; an event without payments gives none."""
    return events.select("booking_id", F.explode("payments").alias("payment")).select(
        "booking_id",
        "payment.payment_id",
        F.col("payment.method").alias("payment_method"),
        F.col("payment.amount").alias("payment_amount"),
        F.current_timestamp().alias("ingested_at"),
    )


def flatten_booking(bronze: DataFrame) -> DataFrame:
    """Nested booking to the flat columns the silver rules read."""
    names = {
        "customer_id": "customer.customer_id",
        "customer_name": "customer.name",
        "email": "customer.email",
        "loyalty_tier": "customer.loyalty.tier",
        "loyalty_points": "customer.loyalty.points",
        "pickup_location": "booking_details.pickup.location",
        "pickup_time": "booking_details.pickup.time",
        "drop_location": "booking_details.drop.location",
        "drop_time": "booking_details.drop.time",
    }
    extra = [c for c in ("ingested_at",) if c in bronze.columns]
    return bronze.select(
        "booking_id", "booking_date", *[F.col(path).alias(name) for name, path in names.items()], *extra
    )
