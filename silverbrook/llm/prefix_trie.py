"""The prefix trie of conversations by truncation peeling (operator 13).

A conversation is a chain of digests, one for each of its prefixes. Peeling goes down from the greatest depth: at
depth d the conversations that end there and the nodes that survive from d + 1, each cut by its last turn, are grouped
by the digest of their first d turns. A group is a node of the trie, found and finished at once: its members, children,
leaves and tokens are sums over the group. Then the node loses its last turn and goes on as a survivor.

Levels are peeled together where that is safe: rows that share the first f + 1 turns meet in one task, which peels all
depths above f. The floor f is the smallest one whose largest group of rows is bounded, so a prefix that very many
different conversations share raises the floor, and where even the deepest level has such a group, that level alone is
one aggregate with map-side combination. Every round's nodes are a written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keyed import lookup_left_join
from . import common

#: A group is peeled in one task while it has at most this share of all turns, and at most so many turns; groups of no
#: more than the least are never split.
GROUP_SHARE, GROUP_MOST, GROUP_LEAST = 1 / 64, 1 << 16, 1 << 8
#: Turns a task peels at once, in whole groups.
CHUNK_TURNS = 1 << 17
#: Bytes of joined ids in one piece of a node's list of ended conversations.
PIECE_BYTES = 1 << 16
DIGEST_BYTES = 16
HEADS, EVERY = 6, 100
EMPTY = hashlib.sha256(b"").hexdigest()

_PATH = "path array<binary>, chars array<bigint>"
_NODE = "digest binary, parent binary, depth bigint, conv bigint, parent_conv bigint, n bigint, children bigint, leaves bigint, saved bigint, ends string"


def rebuilt(conversations: DataFrame, heads: int = HEADS, every: int = EVERY) -> DataFrame:
    """``conv_id, turns`` (``key``, ``chars``) of every conversation, begun with turns of its block's first one.

    Conversation ``c`` begins with the first ``h`` turns of ``c - c % every``, ``h`` being the CRC-32 of its decimal
    id modulo ``heads``, and goes on with its own turns after the first ``h``. A turn is known by 128 bits of the
    digest of role and text, so texts are read once and never shuffled. Turns are ordered by ``turn``, null first;
    equal ones by role, then digest. Rows without an id belong to no conversation.

    A conversation is one row, some 24 bytes a turn: its chain of digests is sequential by nature.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    written = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    key = F.substring(F.unhex(F.sha2(written.cast("binary"), 256)), 1, DIGEST_BYTES)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), key.alias("key"),
        F.length(text).cast("bigint").alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    ranked = turns.withColumn("rank", F.row_number().over(order))
    own = ranked.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("rank", "key", "chars"))).alias("all"))
    own = common.written(own, "conversations")
    bare = lambda all_: F.transform(all_, lambda t: F.struct(t["key"].alias("key"), t["chars"].alias("chars")))
    first = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("block"), F.slice("all", 1, max(heads - 1, 1)).alias("first")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.withColumn("block", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h).join(first, "block", "left")
    head = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast(dict(first.dtypes)["first"]))
    return both.select("conv_id", bare(F.concat(head, F.filter("all", lambda t: t["rank"] > F.col("h")))).alias("turns"))


def _chained(turns: DataFrame) -> DataFrame:
    """``conv_id, path, chars``: digests of all prefixes, each of the one before and the next turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            keys, chars = column.flatten().flatten()
            sizes = np.diff(np.asarray(column.offsets))
            at, flat, paths = 0, keys.to_pylist(), []
            for size in sizes:
                digest = b""
                for key in flat[at : at + size]:
                    digest = hashlib.blake2b(digest + key, digest_size=DIGEST_BYTES).digest()
                    paths.append(digest)
                at += size
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(offsets, pa.array(paths, pa.binary())), pa.ListArray.from_arrays(offsets, chars)],
                names=["conv_id", "path", "chars"],
            )

    return turns.mapInArrow(run, f"conv_id bigint, {_PATH}")


def _last(path: str = "path") -> Column:
    return F.coalesce(F.try_element_at(F.col(path), F.lit(-1)), F.lit(b""))


def ended_digests(members: DataFrame) -> DataFrame:
    """``digest, ends``: SHA-256 of the ascending, comma-joined ids of all rows ``(digest, conv_id)`` of a digest.

    A digest may hold a third of all ids, so ids are sorted over all tasks, joined to bounded pieces where they lie,
    and only the pieces of one digest stream through one task, which keeps nothing but the state of the hash.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, digest, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for new, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (new != digest or size >= PIECE_BYTES):
                    out.append((digest, part, number, ",".join(held)))
                    number, held, size = number + 1, [], 0
                digest = new
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield _batch(out, names, kinds)
                out = []
        if held:
            yield _batch([(digest, part, number, ",".join(held))], names, kinds)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, state = None, None
        for batch in batches:
            out = []
            for new, piece in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if new != digest:
                    if state is not None:
                        out.append((digest, state.hexdigest()))
                    digest, state = new, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            if out:
                yield _batch(out, ["digest", "ends"], [pa.binary(), pa.string()])
        if state is not None:
            yield _batch([(digest, state.hexdigest())], ["digest", "ends"], [pa.binary(), pa.string()])

    names, kinds = ["digest", "part", "number", "ids"], [pa.binary(), pa.int32(), pa.int32(), pa.string()]
    ordered = members.select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    found = ordered.mapInArrow(pieces, "digest binary, part int, number int, ids string")
    grouped = found.repartition("digest").sortWithinPartitions("digest", "part", "number")
    return grouped.mapInArrow(hashed, "digest binary, ends string")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _floor(waiting: DataFrame, top: int, limit: int) -> int | None:
    """The smallest floor below ``top`` whose groups all have at most ``limit`` turns to peel; None if there is none."""
    floors = sorted({0, top - 1, *[1 << k for k in range(top.bit_length()) if 1 << k < top]})
    size = F.size("path")
    spread = waiting.select(F.explode(F.array(*[F.lit(f) for f in floors])).alias("floor"), "path", size.alias("size"))
    counted = (
        spread.where("size > floor")
        .groupBy("floor", F.element_at("path", F.col("floor") + 1).alias("key"))
        .agg(F.sum(F.col("size") - F.col("floor")).alias("turns"))
        .groupBy("floor")
        .agg(F.max("turns").alias("turns"))
    )
    largest = {r.floor: r.turns for r in counted.collect()}
    return next((f for f in floors if largest.get(f, 0) <= limit), None)


def peeled(rows: list[tuple], floor: int) -> list[tuple]:
    """Nodes deeper than ``floor`` over waiting rows, from the greatest depth on.

    A row is ``(path, chars, n, conv, leaves, saved, ends, child)``. Nodes come with their parent's smallest member,
    but for those at depth ``floor + 1``, which come with the path and the counts of characters above them.
    """
    levels: dict[int, dict[bytes, list]] = {}

    def merge(path, chars, n, conv, leaves, saved, ends, children):
        node = levels.setdefault(len(path), {}).setdefault(path[-1], [path, chars, 0, conv, 0, 0, 0, None, []])
        node[2] += n
        node[3] = min(node[3], conv)
        node[4] += len(children) if isinstance(children, list) else children
        node[5] += leaves
        node[6] += saved
        node[7] = ends or node[7]
        if isinstance(children, list):
            node[8] += children

    for path, chars, n, conv, leaves, saved, ends, child in rows:
        merge(path, chars, n, conv, leaves, saved, ends, child)
    out: list[list] = []
    for depth in range(max(levels, default=0), floor, -1):
        for digest, (path, chars, n, conv, children, leaves, saved, ends, known) in levels.pop(depth, {}).items():
            for child in known:
                child[4] = conv
            leaves, saved = leaves or 1, saved + (n - 1) * chars[-1]
            above = path[:-1], chars[:-1]
            row = [digest, path[-2] if depth > 1 else b"", depth, conv, None, n, children, leaves, saved, ends, None, None]
            out.append(row)
            if depth - 1 > floor:
                merge(*above, n, conv, leaves, saved, None, [row])
            else:
                row[10:] = above
    return [tuple(row) for row in out]


_PEELED = f"{_NODE}, {_PATH}"
_PEELED_KINDS = [
    pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()),
]
_PEELED_NAMES = [field.split()[0] for field in _PEELED.split(", ")]


def _peel_together(waiting: DataFrame, floor: int) -> DataFrame:
    """All depths above ``floor`` in one shuffle: groups that share ``floor + 1`` turns are whole within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key = [], 0, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= CHUNK_TURNS and row[0][floor] != key:
                    yield _batch(peeled(held, floor), _PEELED_NAMES, _PEELED_KINDS)
                    held, size = [], 0
                key = row[0][floor]
                held.append(row)
                size += len(row[0]) - floor
        if held:
            yield _batch(peeled(held, floor), _PEELED_NAMES, _PEELED_KINDS)

    order = ["path", "chars", "n", "conv", "leaves", "saved", "ends", "child"]
    key = F.element_at("path", floor + 1)
    together = waiting.withColumn("key", key).repartition("key").sortWithinPartitions("key").select(*order)
    return together.mapInArrow(run, _PEELED)


def _peel_level(waiting: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth: one aggregate, combined before the shuffle."""
    cut = lambda c: F.slice(c, 1, max(depth - 1, 0))
    found = waiting.groupBy(_last().alias("digest")).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), F.sum("child").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
        F.first("path").alias("path"), F.first("chars").alias("chars"),
    )
    last = F.coalesce(F.try_element_at("chars", F.lit(-1)), F.lit(0))
    return found.select(
        "digest", (F.element_at("path", -2) if depth > 1 else F.lit(b"")).alias("parent"),
        F.lit(depth).cast("bigint").alias("depth"), "conv", F.lit(None).cast("bigint").alias("parent_conv"), "n",
        F.col("children").cast("bigint").alias("children"), F.greatest("leaves", F.lit(1)).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * last).alias("saved"), "ends", cut("path").alias("path"), cut("chars").alias("chars"),
    )


def _with(ended: DataFrame, survivors: DataFrame | None) -> DataFrame:
    return ended if survivors is None else ended.unionByName(survivors)


def _survivors(nodes: DataFrame) -> DataFrame:
    """Nodes finished last, cut by their last turn, for their parents' groups; all are equally deep."""
    return nodes.where(F.col("path").isNotNull()).select(
        "path", "chars", "n", "conv", "leaves", "saved", F.lit(None).cast("string").alias("ends"), F.lit(1).alias("child")
    )


def prefix_trie(conversations: DataFrame, heads: int = HEADS, every: int = EVERY) -> DataFrame:
    """Every node of the trie of rebuilt conversations, the root included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and ``digest``, ``parent`` as keys of the nodes. See ``rebuilt``
    for what a conversation is. Null role or text is empty; repeated rows are turns of their own; equal conversations
    share all their nodes; a conversation without turns is a member of the root alone. Texts may be of any length. An
    empty table gives no rows. Other columns are ignored.
    """
    chains = common.written(_chained(rebuilt(conversations, heads, every)), "chains")
    members = chains.select(_last().alias("digest"), "conv_id")
    sequences = chains.groupBy(_last().alias("digest")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"), F.first("path").alias("path"), F.first("chars").alias("chars")
    )
    zero = F.lit(0).cast("bigint")
    ended = common.written(
        sequences.join(ended_digests(members), "digest", "left").select(
            "path", "chars", "n", "conv", zero.alias("leaves"), zero.alias("saved"), "ends", F.lit(0).alias("child")
        ),
        "ended",
    )
    shape = ended.agg(F.max(F.size("path")).alias("top"), F.sum(F.size("path")).alias("turns")).first()
    if shape.top is None:
        return _named(conversations.sparkSession.createDataFrame([], _NODE))
    limit = max(GROUP_LEAST, min(GROUP_MOST, int(shape.turns * GROUP_SHARE)))
    top, tables, survivors = shape.top, [], None
    while top > 0:
        waiting = _with(ended.where(F.size("path") <= top), survivors)
        floor = _floor(waiting, top, limit)
        if floor is None:
            floor, step = top - 1, _peel_level(waiting.where(F.size("path") == top), top)
        else:
            step = _peel_together(waiting.where(F.size("path") > floor), floor)
        tables.append(common.written(step, f"nodes-{floor}"))
        survivors, top = _survivors(tables[-1]), floor
    tables.append(common.written(_peel_level(_with(ended.where(F.size("path") == 0), survivors), 0), "nodes-root"))
    return _named(_with_parents([t.drop("path", "chars") for t in tables]))


def _with_parents(tables: list[DataFrame]) -> DataFrame:
    """All nodes with their parent's smallest member, looked up where parent and child were found in different rounds."""
    nodes = reduce(DataFrame.unionByName, tables)
    done = nodes.where(F.col("parent_conv").isNotNull() | (F.col("depth") == 0))
    rest = nodes.where(F.col("parent_conv").isNull() & (F.col("depth") > 0)).drop("parent_conv")
    # The root is one row: its children take its member as a scalar, however many they are.
    root = tables[-1].select("conv").scalar()
    top = rest.where(F.col("depth") == 1).withColumn("parent_conv", root)
    if len(tables) > 2:
        parents = nodes.select(F.col("digest").alias("parent"), F.col("conv").alias("parent_conv"))
        top = top.unionByName(lookup_left_join(rest.where(F.col("depth") > 1), parents, ["parent"]))
    return done.unionByName(top)


def _named(nodes: DataFrame) -> DataFrame:
    root = F.col("depth") == 0
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.when(~root, F.col("parent_conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
        "digest", F.when(~root, F.col("parent")).alias("parent"),
    )
