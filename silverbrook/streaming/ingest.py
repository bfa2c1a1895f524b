"""From the event stream to bronze and silver tables.

Checkpoints live under the lake root, so a restarted or rebuilt driver resumes. Two layouts are offered:
three independent append queries, as published, off messages that another query has decoded, and one query that
decodes each batch once for all three tables and is idempotent per batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import Settings
from ..sources import events as ev
from ..sources.tables import PACKED, balanced, staged, table_exists, upsert

# Table name -> how it is cut from decoded events, and its partition columns.
BRONZE: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "booking": (ev.bronze_booking, ("year", "month", "day")),
    "cars": (ev.bronze_cars, ()),
    "payments": (ev.bronze_payments, ()),
}
REJECTS = "rejects"
# Decoded messages, events and rejects alike, and how many of their files a batch of a table takes.
DECODED = "decoded"
DECODED_FILES = 64
# Digests of the messages each run of the single-pass stream has written.
LEDGER = "_messages"


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stream to a table with its own checkpoint, up to what is available now.

    Rows of a partition value are brought together before the write, so that a batch adds few files to it
    instead of one per task.
    """
    frame = balanced(df, partition_by) if partition_by else df
    writer = frame.writeStream.format("parquet").options(**PACKED).outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def decoded_stream(messages: DataFrame) -> DataFrame:
    """The events of a message stream; what is no event belongs to ``rejected_stream``."""
    good, _ = ev.split_decoded(ev.decode_json(messages))
    return good


def rejected_stream(messages: DataFrame) -> DataFrame:
    _, bad = ev.split_decoded(ev.decode_json(messages))
    return bad


def start_bronze(messages: DataFrame, settings: Settings) -> dict[str, StreamingQuery]:
    """Independent append queries off one message stream: the three tables (T01, T03) and the rejects.

    Parsing a message costs more than all else done to it, so a query before them does that once: what it appends to a
    table of its own is the stream the four read, each from its own checkpoint. It is bounded and waited for.
    """
    decoded = ev.decode_json(messages)
    path = settings.table_path("bronze", DECODED)
    finish({DECODED: append_stream(decoded, path, settings.checkpoint_path(DECODED))})
    source = decoded.sparkSession.readStream.schema(decoded.schema).option("maxFilesPerTrigger", DECODED_FILES)
    good, bad = ev.split_decoded(source.parquet(path))
    rejects = append_stream(bad, settings.table_path("bronze", REJECTS), settings.checkpoint_path(REJECTS))
    return {REJECTS: rejects} | {
        name: append_stream(
            cut(good), settings.table_path("bronze", name), settings.checkpoint_path(name), partition_by
        )
        for name, (cut, partition_by) in BRONZE.items()
    }


def finish(queries: dict[str, StreamingQuery], timeout_seconds: int | None = None) -> None:
    """Wait for bounded queries; one that outlives the timeout is stopped, and a failure is raised."""
    for name, query in queries.items():
        if timeout_seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_seconds):
            query.stop()
            raise TimeoutError(f"stream {name} did not finish in {timeout_seconds} s")


def start_bronze_once(messages: DataFrame, settings: Settings) -> StreamingQuery:
    """One query writing all bronze tables and the rejects, decoding every message once.

    Slices are named by run and batch. A run is the life of a checkpoint: its name is written beside the offsets
    and goes with them, so a new checkpoint, whose batches count from 0 again, never replaces another run's
    slices. Within a run a batch that is run again replaces its own slice and leaves exactly one copy. What an
    earlier run has written is left out of a later one by message identity: topic, partition and offset where the
    source has them, else a digest of key and value, by which a message that repeats an earlier run's is that run's.
    """
    checkpoint = settings.checkpoint_path("bronze")
    identity = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    identity = identity if len(identity) == 3 else ["key", "value"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_name(spark, checkpoint)
        ledger = settings.table_path("bronze", LEDGER)
        named = batch.withColumn("_id", F.sha2(F.to_json(F.struct(*[F.col(c).cast("string") for c in identity])), 256))
        if table_exists(spark, ledger):
            others = spark.read.schema("id string, run string, batch string").parquet(ledger).filter(F.col("run") != run)
            named = unknown_messages(named, others.select(F.col("id").alias("_id")).distinct())
        # Written, not kept: decoded rows take several times the room of their files, and a batch may be large.
        decoded = staged(ev.decode_json(named, carry=("_id",)), "bronze-batch")
        good, bad = ev.split_decoded(decoded)
        for name, (cut, partition_by) in BRONZE.items():
            _write_slice(cut(good), settings.table_path("bronze", name), run, batch_id, partition_by)
        _write_slice(bad, settings.table_path("bronze", REJECTS), run, batch_id)
        # Last, so that a batch that failed half-way is not taken for written.
        _write_slice(decoded.select(F.col("_id").alias("id")), ledger, run, batch_id)

    return _foreach(messages, write, checkpoint)


def unknown_messages(named: DataFrame, known: DataFrame) -> DataFrame:
    """Messages whose ``_id`` is not among the distinct ``known`` ones.

    Identities alone are counted first: a batch is as a rule all new or all known, and its texts then need no shuffle.
    """
    met = named.select("_id").join(known.withColumn("_known", F.lit(True)), "_id", "left")
    n, n_known = met.agg(F.count(F.lit(1)), F.count("_known")).first()
    if n_known == 0:
        return named
    return named.limit(0) if n_known == n else named.join(known, "_id", "left_anti")


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint's life, made on its first batch."""
    path = f"{checkpoint}/run"
    if not table_exists(spark, path):
        spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first().value


def _write_slice(frame: DataFrame, path: str, run: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    writer = (balanced(frame, partition_by) if partition_by else frame).write.mode("overwrite").options(**PACKED)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/run={run}/batch={batch_id}")


def start_upsert(
    df: DataFrame, path: str, keys: Sequence[str], checkpoint: str, newest_first: Sequence[str] = ()
) -> StreamingQuery:
    """Keep a keyed table current from a stream (T06): replayed batches update rows to the same values."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, batch, path, keys, newest_first)

    return _foreach(df, write, checkpoint)


def _foreach(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def silver_payments_stream(messages: DataFrame) -> DataFrame:
    """Cleaned payments as a stream, without the count that needs all payments of a booking."""
    from ..plans.silver import silver_payments

    return silver_payments(ev.bronze_payments(decoded_stream(messages)), payment_counts=False)


