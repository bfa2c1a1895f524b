"""Packing documents into sequences by minimum bin slack (operator 1).

A document's ids are cut into whole sequences and one remainder. Whole sequences need no packing. Remainders of a
task wait in a pool of counts by length; each window takes the largest remainder and, from a bitset dynamic
program over the counts, the multiset of other lengths that fills it closest to capacity. The bitset of each step
is kept, so the chosen counts are read back from the last step to the first. A multiset is used again while the
pool holds all of it.

Nothing is shuffled but what each task could not pack without slack: a few remainders, packed once more together.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens

CAPACITY = 2048
#: Ids in a task's pool above which windows are closed, and below which they wait for a better choice.
POOL_HIGH, POOL_LOW = 1_000_000, 500_000
#: Ids of leftovers that one task packs in the second pass.
LEFTOVER_IDS = 4_000_000

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)
_ARROW = common.arrow_schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def least_slack(counts: dict[int, int], capacity: int, lengths: list[int] | None = None) -> dict[int, int]:
    """The multiset of lengths that fills ``capacity`` best and holds the largest length; ``counts`` are available.

    Bit ``s`` of a step's bitset says that some choice of the steps so far sums to ``s``. A count enters as chunks
    of 1, 2, 4, ... copies, so a length takes as many steps as its count has binary digits. The program stops at
    the first exact fill. ``lengths`` are those that are available, the largest first, where the caller keeps them.
    """
    if lengths is None:
        lengths = sorted((n for n, c in counts.items() if c and n <= capacity), reverse=True)
    if not lengths:
        return {}
    chosen = {lengths[0]: 1}
    room = capacity - lengths[0]
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for i, length in enumerate(lengths):
        if length > room:
            continue
        left, chunk = counts[length] - (i == 0), 1
        while left > 0 and chunk * length <= room:
            take = min(chunk, left)
            after = (reach | reach << take * length) & mask
            if after != reach:
                steps.append((reach, length, take))
                reach = after
            left -= take
            chunk *= 2
        if reach >> room & 1:
            break
    target = reach.bit_length() - 1
    for before, length, take in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + take
            target -= take * length
    return chosen


class _Pool:
    """Remainders of a task by length; ``close`` turns them into sequences."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.size = capacity, first, 0
        self.waiting: dict[int, deque] = defaultdict(deque)

    def add(self, piece: tuple) -> None:
        self.waiting[piece[2]].append(piece)
        self.size += piece[2]

    def whole(self, piece: tuple) -> tuple:
        self.next += 1
        return (*piece, self.next - 1, 0)

    def close(self, down_to: int, final: bool) -> Iterator[tuple]:
        """Pieces with their places; without ``final``, what has slack comes out unplaced."""
        counts = {n: len(q) for n, q in self.waiting.items()}
        lengths = sorted(counts, reverse=True)
        while self.size > down_to:
            pattern = least_slack(counts, self.capacity, lengths)
            filled = sum(n * c for n, c in pattern.items())
            placed = filled == self.capacity or final
            queues = [self.waiting[n] for n in sorted(pattern, reverse=True) for _ in range(pattern[n])]
            times = min(counts[n] // c for n, c in pattern.items())
            for _ in range(times):
                offset = 0
                for queue in queues:
                    piece = queue.popleft()
                    yield (*piece, self.next if placed else None, offset if placed else None)
                    offset += piece[2]
                self.next += placed
            self.size -= times * filled
            for n, c in pattern.items():
                counts[n] -= times * c
                if not counts[n]:
                    lengths.remove(n)
        self.waiting = defaultdict(deque, {n: q for n, q in self.waiting.items() if q})


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row[2] + 64
        if size > 1_000_000:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = tokens.TOKENIZER) -> DataFrame:
    """Pieces of all documents with their place in a sequence of at most ``capacity`` ids.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null text counts as empty, and an empty
    one has the end id alone, so every row has at least one piece. A row with a null ``doc_id`` is packed like any
    other. Repeated rows are packed each on its own. An empty table gives no pieces. ``ids`` holds a piece's ids as
    little-endian unsigned 32-bit integers; ``start`` counts the ids of its document before it. Only texts, and no
    whole partition, are ever in memory: a task holds its pool of remainders.
    """

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokens.encoder(tokenizer)
        pool = _Pool(capacity, TaskContext.get().partitionId() << 40)

        def rows() -> Iterator[tuple]:
            for batch in common.sliced(batches, "text"):
                names = batch.column(0).to_pylist()
                for doc_id, ids in zip(names, encode(tokens.texts_of(batch)), strict=True):
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        length = min(capacity, total - start)
                        piece = (doc_id, start, length, ids[4 * start : 4 * (start + length)], total)
                        if length == capacity:
                            yield pool.whole(piece)
                        else:
                            pool.add(piece)
                    if pool.size > POOL_HIGH:
                        yield from pool.close(POOL_LOW, False)
            yield from pool.close(0, False)

        return _batches(rows())

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pool = _Pool(capacity, (1 << 62) + (TaskContext.get().partitionId() << 40))

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for piece in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                    pool.add(piece)
                if pool.size > 2 * LEFTOVER_IDS:
                    yield from pool.close(LEFTOVER_IDS, True)
            yield from pool.close(0, True)

        return _batches(rows())

    first = common.written(docs.select("doc_id", "text").mapInArrow(first_pass, SCHEMA), "packing")
    left = first.where("sequence_id is null")
    ids = left.agg(F.sum("length")).first()[0] or 0
    # The key only spreads; the pieces of one task may come in any order.
    left = left.repartition(1 + ids // LEFTOVER_IDS, F.xxhash64("doc_id", "start"))
    return first.where("sequence_id is not null").unionByName(left.mapInArrow(second_pass, SCHEMA))
