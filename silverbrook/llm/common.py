"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, ship_package

#: Sides of a join with at most so many ids (some 80 bytes each once built) are broadcast; larger ones are shuffled.
BROADCAST_IDS = 1_000_000
#: Rows and bytes of text in one Arrow batch: long texts must not add up in a Python worker or beside the heap.
BATCH_ROWS, BATCH_BYTES = 4_000, 16 << 20
#: Texts are worked through in slices of about so many bytes, whatever the size of an Arrow batch.
SLICE_BYTES = 8 << 20

_SEPARATORS = [b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]
#: Byte map for words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased: separators become spaces.
_WORD_BYTES = bytes(0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: reused results survive lost executors, lineage ends here."""
    bounded_batches(df.sparkSession)
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: str) -> list[bytes]:
    """Lower-cased words (letters, digits and everything beyond ASCII) of a whole text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def with_bounded_side(left: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join by id; the id list is broadcast only when counted and small."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return left.join(F.broadcast(ids) if few else ids, key, how)


def free_name(df: DataFrame, name: str) -> str:
    """A column name no column of ``df`` has, compared without case as Spark does."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_schema(fields: Iterable[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in fields])


def sliced(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``SLICE_BYTES`` of the text column, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        block = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """One 0/1 label a document: the mean of repeated labels, 1 from one half on; null labels and ids are dropped."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for rows no label may be learned from: ``crc32(id as text) mod 5 = 0``."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def components(edges: DataFrame, label: str) -> DataFrame:
    """Smallest node reachable from each node of undirected ``(a, b)`` edges, as ``(node, component)``.

    Alternating large-star and small-star rounds: a node keeps only edges towards the smallest neighbour it knows,
    so the edge count never grows and chains shorten geometrically. Both rounds are aggregates with map-side
    combination and a join on the node. Every round is a written table; the last table is a forest of stars.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = written(pairs, f"{label}-edges")
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{label}-stars")
        differ = after.exceptAll(pairs).limit(1).count() or pairs.exceptAll(after).limit(1).count()
        pairs = after
        if not differ:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select("v", "v").distinct()
    )
