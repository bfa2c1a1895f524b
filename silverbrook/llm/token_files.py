"""Flat token files with document offsets (operator 5).

Format: a shard is a pair of files. ``NAME.ids`` holds the ids of its documents one after another, unsigned and
little-endian, two bytes wide where the vocabulary allows it and else four. ``NAME.idx`` holds little-endian signed
64-bit integers: the number of documents n, the width of an id in bytes, n document ids, and n + 1 offsets counted
in ids from the shard's beginning. Shards follow each other in ascending order of document id and hold about
``SHARD_IDS`` ids, or one document that is longer. A shard's base, the ids of all shards before it, is the prefix sum
over the totals of partitions plus what its own partition wrote before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens

WIDTHS = {2: "<u2", 4: "<u4"}
#: A task writes a shard out when it holds so many ids, so its memory does not grow with its partition.
SHARD_IDS = 1 << 24
#: Texts of one id, also of the null one, spread over partitions by so many characters of theirs.
KEY_CHARS = 64
#: Beyond so many shards a reading task takes several, one after another.
READ_TASKS = 20_000
_WRITTEN = "shard int, name string, documents bigint, ids bigint, before bigint"


def _filesystem(folder: str):
    """Arrow's view of a folder named by any URI Spark understands, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _put(folder: str, name: str, parts: list) -> None:
    """A file that appears whole or not at all: a repeated task writes the same name with the same bytes."""
    system, root = _filesystem(folder)
    system.create_dir(root, recursive=True)
    draft = f"{root}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    system.move(draft, f"{root}/{name}")


def _get(folder: str, name: str) -> np.ndarray:
    """A file's bytes, memory-mapped where the folder is a mounted one."""
    system, root = _filesystem(folder)
    path = f"{root}/{name}"
    if type(system).__name__ == "LocalFileSystem":
        with pa.memory_map(path) as source:
            return np.frombuffer(source.read_buffer(), dtype=np.uint8)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=np.uint8)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str = tokens.TOKENIZER, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Encode whole texts and write shards in ascending ``doc_id`` order; returns the manifest, one row a shard.

    Rows with a null ``doc_id`` come first, under the id -1 << 63. Equal ids are ordered by text, nulls first; a
    null text counts as empty and has the end id alone. Other columns are ignored; an empty table has no shard.
    Texts are range-partitioned by id and first characters and sorted; a task holds the ids of one shard at a time,
    whatever the partition's size. The driver sees one total a partition.
    """
    spark = docs.sparkSession
    null_id = -(1 << 63)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = tokens.encoder(tokenizer)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        parts, names, sizes, number, before = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            name = f"shard-{shard:06d}-{number:06d}"
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            _put(folder, f"{name}.ids", parts)
            _put(folder, f"{name}.idx", [np.array([len(names), width, *names, *offsets], dtype="<i8").tobytes()])
            return pa.RecordBatch.from_pydict(
                {"shard": [shard], "name": [name], "documents": [len(names)], "ids": [held], "before": [before]},
                schema=pa.schema(
                    [("shard", pa.int32()), ("name", pa.string())]
                    + [(n, pa.int64()) for n in ("documents", "ids", "before")]
                ),
            )

        held = 0
        for batch in common.sliced(batches, "text"):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(tokens.texts_of(batch)), strict=True):
                names.append(null_id if doc_id is None else doc_id)
                sizes.append(len(ids) // 4)
                parts.append(np.frombuffer(ids, "<u4").astype(WIDTHS[width]).tobytes())
                held += sizes[-1]
                if held >= shard_ids:
                    yield flush()
                    before, number, held = before + held, number + 1, 0
                    parts, names, sizes = [], [], []
        if names:
            yield flush()

    key = F.left("text", F.lit(KEY_CHARS))
    sorted_docs = docs.select("doc_id", "text").repartitionByRange("doc_id", key).sortWithinPartitions("doc_id", "text")
    shards = common.written(sorted_docs.mapInArrow(encode, _WRITTEN), "shards")
    base, bases = 0, []
    for row in sorted(shards.groupBy("shard").agg(F.sum("ids").alias("ids")).collect()):
        bases.append((row.shard, base))
        base += row.ids
    known = spark.createDataFrame(bases, "shard int, first bigint")
    return shards.join(F.broadcast(known), "shard").select(
        "shard", "name", "documents", "ids", (F.col("first") + F.col("before")).alias("base")
    )


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Documents from the files: ``doc_id, start, n_tokens, ids`` with ids as little-endian unsigned 32-bit bytes."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                index = _get(folder, f"{name}.idx").view("<i8")
                n, width = int(index[0]), int(index[1])
                names, offsets = index[2 : 2 + n], index[2 + n : 3 + 2 * n]
                ids = _get(folder, f"{name}.ids").view(WIDTHS[width])
                low = 0
                while low < n:
                    high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + 500_000, "right")) - 1)
                    some = ids[offsets[low] : offsets[high]].astype("<u4")
                    ends = 4 * (offsets[low : high + 1] - offsets[low])
                    column = pa.Array.from_buffers(
                        pa.large_binary(), high - low, [None, pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(some)]
                    ).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[low:high]),
                            pa.array(base + offsets[low:high]),
                            pa.array(np.diff(offsets[low : high + 1])),
                            column,
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    low = high

    shards = manifest.select("name", "base")
    files = max(1, min(manifest.count(), READ_TASKS))
    read = shards.repartition(files, "name").mapInArrow(decode, schema)
    return read.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
