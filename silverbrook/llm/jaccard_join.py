"""Exact Jaccard self-join on word shingles by T-occurrence search (operator 4).

Work shrinks in exact steps before anything is searched. ``T = ceil(0.85 n)`` shingles of a set of n must occur in
a linked partner, so at most ``n - T`` may be missing.

1. One pass over the texts hashes shingles. Equal sets form a class; only one row of it goes on.
2. The first ``n - T + 1 + n // 10`` hashes of a set, in hash order, hold at least ``1 + ceil(0.85 n) // 10``
   hashes that a partner's own prefix holds too. Sets whose prefixes share fewer with any other are done.
3. For the sets that stay, all shingles are counted and ordered by frequency, rarest first. Shingles of one set
   alone only use up its slack. What is left of the prefix deals sets to groups: sets that share a prefix shingle
   are in one group. A common line or passage is frequent, so it deals nothing unless it is most of a text.
4. Groups are cut into slices of bounded size by a hash of the id; every pair of slices of a group is a task. It
   searches each set of one slice in the other's inverted lists (``linked``): short lists are merged, long ones
   probed by binary search, and sets reaching T are kept and measured. A task returns for each set its number of
   links and the smallest set of its local component: a star, never the pairs.
5. Connected components over the stars.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import lookup_left_join
from . import common

SIZE, PERCENT = 4, 85
#: Shingles and sets of one slice of a group.
SLICE_SHINGLES, SLICE_SETS = 400_000, 8_000
#: Rows of one class of equal sets, or of its representative, from which a lookup cuts it into slices.
HOT_ROWS = 200_000
#: Weight of a binary probe against a merge step in DivideSkip's choice of long lists.
PROBE_WEIGHT = 0.05

_MIX, _MULTIPLY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles; words are hashed once and remembered."""

    def __init__(self, size: int, remembered: int = 800_000):
        import xxhash

        self.size, self.remembered = size, remembered
        self.digest = xxhash.xxh3_64_intdigest
        self.signature = xxhash.xxh3_128_digest
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not parts:
            return np.empty(0, dtype=np.int64)
        if len(self.known) > self.remembered:
            self.known.clear()
        known = self.known
        for word in set(parts):
            if word not in known:
                known[word] = self.digest(word)
        hashes = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        width = min(self.size, len(parts))
        rows = len(parts) - width + 1
        mixed = np.full(rows, width, dtype=np.uint64)
        for i in range(width):
            mixed = (mixed ^ hashes[i : i + rows]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        mixed *= _MULTIPLY
        return np.unique((mixed ^ (mixed >> np.uint64(32))).view(np.int64))

    def class_of(self, hashes: np.ndarray) -> tuple[int, int]:
        a, b = np.frombuffer(self.signature(hashes.tobytes()), dtype="<i8")
        return int(a), int(b)


def _least(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _hashed(docs: DataFrame, size: int, percent: int, whole: bool) -> DataFrame:
    """``doc_id, n, s1, s2, hashes``: all hashes, or the first in hash order that step 2 compares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in common.sliced(batches, "text"):
            n, first, second, kept = [], [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingler(text)
                a, b = shingler.class_of(hashes)
                n.append(len(hashes))
                first.append(a)
                second.append(b)
                few = len(hashes) - _least(len(hashes), percent) + 1 + len(hashes) // 10
                kept.append(hashes if whole else hashes[:few])
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(kept)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), lists],
                names=["doc_id", "n", "s1", "s2", "hashes"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, hashes array<bigint>"
    )


def linked(index: list[np.ndarray], index_n: np.ndarray, query: np.ndarray, n: int, percent: int, lists=None) -> np.ndarray:
    """Positions of the indexed sets linked with a query set, by T-occurrence search.

    Sets are given by the shingles that occur in several sets; ``n`` counts all of a set's shingles. ``lists`` are
    the sorted (shingle, position) arrays of :func:`inverted`.
    """
    keys, owners = lists if lists is not None else inverted(index)
    least = _least(n, percent)
    starts, ends = np.searchsorted(keys, query, "left"), np.searchsorted(keys, query, "right")
    some = ends > starts
    starts, ends = starts[some], ends[some]
    if len(starts) < least:
        return np.empty(0, dtype=np.int64)
    order = np.argsort(ends - starts, kind="stable")
    starts, ends = starts[order], ends[order]
    longest = int(ends[-1] - starts[-1])
    long = min(least - 1, int(least / (PROBE_WEIGHT * math.log2(longest + 1) * 20 + 1)))
    short = len(starts) - long
    merged = np.concatenate([owners[s:e] for s, e in zip(starts[:short], ends[:short], strict=True)])
    found, seen = np.unique(merged, return_counts=True)
    enough = seen >= least - long
    found, seen = found[enough], seen[enough]
    for s, e in zip(starts[short:], ends[short:], strict=True):
        if not len(found):
            break
        run = owners[s:e]
        at = np.minimum(np.searchsorted(run, found), len(run) - 1)
        seen = seen + (run[at] == found)
    return found[100 * seen >= percent * (n + index_n[found] - seen)]


def inverted(index: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate(index) if index else np.empty(0, dtype=np.int64)
    owners = np.repeat(np.arange(len(index)), [len(s) for s in index])
    order = np.argsort(keys, kind="stable")
    return keys[order], owners[order]


def _search(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One pair of slices; ``role`` is 0 for queries, 1 for the index, 2 for both."""
        sets, n = [np.asarray(h) for h in pdf["hashes"]], pdf["n"].to_numpy()
        ids, size, role = pdf["cid"].to_numpy(), pdf["size"].to_numpy(), pdf["role"].to_numpy()
        indexed, asked = np.flatnonzero(role >= 1), np.flatnonzero(role != 1)
        lists = inverted([sets[i] for i in indexed])
        parent, links = list(range(len(ids))), np.zeros(len(ids), dtype=np.int64)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for x in asked:
            partners = indexed[linked([], n[indexed], sets[x], int(n[x]), percent, lists)]
            partners = partners[partners != x]
            links[x] += size[partners].sum()
            if role[x] == 0:
                links[partners] += size[x]
            for y in partners:
                a, b = root(x), root(int(y))
                if ids[a] <= ids[b]:
                    parent[b] = a
                else:
                    parent[a] = b
        some = np.flatnonzero(links)
        return pd.DataFrame({"a": ids[some], "b": [ids[root(int(i))] for i in some], "links": links[some]})

    return run


def _prefix_length(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100) + 1


@dataclass(frozen=True)
class Linked:
    """What the join knows: every row's class, and the component of every class that others link with."""

    members: DataFrame  # doc_id, n, cid, rep, size: a row of the input each; cid is null for rows without a class
    classes: DataFrame  # cid, rep, s1, s2, n, size: a class of equal sets each; rep is its smallest doc_id
    known: DataFrame  # cid, root, component_id, links: classes with links; root is the class the component is named by


def link_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> Linked:
    """Classes of equal sets and their links. Only classes are searched, one row each, whatever rows they stand for:
    repeated rows, and one ``doc_id`` on several texts, add no link that does not hold between sets.
    """
    sets = common.written(_hashed(docs, size, percent, whole=False), "jaccard-sets", "none")
    named = sets.where("n > 0 and doc_id is not null")
    grouped = named.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"))
    # Numbered once, in a written table; numbers rise with the smallest id, so the smallest class of a component has it.
    ordered = grouped.repartitionByRange("rep", "s1", "s2", "n").sortWithinPartitions("rep", "s1", "s2", "n")
    classes = common.written(ordered.withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")
    # A class may own much of all rows: this lookup spreads hot keys.
    members = common.written(
        lookup_left_join(named.select("doc_id", "n", "s1", "s2"), classes, ["s1", "s2", "n"], HOT_ROWS)
        .select("doc_id", "n", "cid", "rep", "size")
        .unionByName(sets.where("n = 0 or doc_id is null").select("doc_id", "n"), allowMissingColumns=True),
        "jaccard-members",
    )

    rows = named.select("doc_id", "n", F.explode("hashes").alias("h"))
    shared = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("h")
    wanted = 1 + F.floor(F.ceil(F.col("n") * percent / 100) / 10)
    stay = rows.join(shared, "h").groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= wanted)
    stay = stay.select("doc_id").distinct()
    # A class goes on by the texts of its smallest id. Where that id stands on several rows, its texts are told apart
    # by their sets, and equal ones are cut to one row.
    several = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    searched = classes.select(F.col("rep").alias("doc_id"), "cid", "s1", "s2", "n").join(stay, "doc_id", "left_semi")
    searched = common.written(
        searched.join(several.select("doc_id", F.lit(True).alias("several")), "doc_id", "left"), "jaccard-stay"
    )
    wanted_ids = searched.select("doc_id").distinct()
    chosen = common.with_bounded_side(docs.select("doc_id", "text"), wanted_ids, "doc_id", "left_semi")
    full = common.written(_hashed(chosen, size, percent, whole=True), "jaccard-full", "none")
    single = searched.where("several is null").select("doc_id", "cid")
    every = _numbered(full, single).select("cid", "n", F.explode("hashes").alias("h"))
    again = searched.where("several").select("cid", "s1", "s2", "n")
    if again.limit(1).count():
        repeated = full.join(searched.where("several").select("doc_id").distinct(), "doc_id", "left_semi")
        one = repeated.join(again, ["s1", "s2", "n"]).dropDuplicates(["cid"])
        every = every.unionByName(one.select("cid", "n", F.explode("hashes").alias("h")))
    often = every.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ordered = (
        every.join(often, "h")
        .groupBy("cid", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("ranked"))
        .withColumn("take", _prefix_length(F.col("n"), percent) - (F.col("n") - F.size("ranked")))
        .where("take > 0")
        .select("cid", "n", F.col("ranked.h").alias("hashes"), F.col("take").cast("int").alias("take"))
    )
    ordered = common.written(ordered, "jaccard-ranked", "none")

    prefixes = ordered.select("cid", F.explode(F.slice("hashes", F.lit(1), F.col("take"))).alias("h"))
    leaders = prefixes.groupBy("h").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z")
    stars = prefixes.join(leaders, "h").select(F.col("cid").alias("a"), F.col("a").alias("b"))
    groups = common.components(stars, "jaccard-groups")

    sized = classes.where("size > 1").select("cid", "size")
    dealt = ordered.join(groups.withColumnRenamed("node", "cid"), "cid").join(sized, "cid", "left")
    dealt = dealt.select("cid", "n", F.sort_array("hashes").alias("hashes"), F.coalesce("size", F.lit(1)).alias("size"),
                         F.col("component").alias("grp"))
    weights = dealt.groupBy("grp").agg(
        F.greatest(
            F.ceil(F.sum(F.size("hashes")) / SLICE_SHINGLES), F.ceil(F.count(F.lit(1)) / SLICE_SETS)
        ).cast("int").alias("slices"),
    )
    dealt = dealt.join(weights, "grp").withColumn("slice", F.pmod(F.xxhash64("cid"), F.col("slices")).cast("int"))
    dealt = common.written(dealt, "jaccard-dealt", "none")
    # Small groups share tasks: sets of different groups may meet there, which adds no link that does not hold.
    small = dealt.where("slices = 1")
    total = small.agg(F.sum(F.size("hashes")).alias("t")).first().t or 0
    bins = 1 + int(total) // (SLICE_SHINGLES // 2)
    both = small.select(
        "cid", "n", "hashes", "size", F.lit(2).alias("role"),
        F.lit(-1).cast("long").alias("grp"), F.pmod(F.xxhash64("grp"), F.lit(bins)).cast("int").alias("i"), F.lit(-1).alias("j"),
    )
    pairs = dealt.where("slices > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    pairs = pairs.select(
        "cid", "n", "hashes", "size",
        F.when(F.col("slice") == F.col("other"), 2).when(F.col("slice") < F.col("other"), 0).otherwise(1).alias("role"),
        "grp", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"),
    )
    found = common.written(
        both.union(pairs).groupBy("grp", "i", "j").applyInPandas(_search(percent), "a bigint, b bigint, links bigint"),
        "jaccard-links",
    )
    labels = common.components(found.select("a", "b"), "jaccard-labels")
    links = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    names = classes.select(F.col("cid").alias("root"), F.col("rep").alias("component_id"))
    rooted = lookup_left_join(labels.select(F.col("node").alias("cid"), F.col("component").alias("root")), names, ["root"], HOT_ROWS)
    return Linked(members, classes, common.written(rooted.join(links, "cid", "left"), "jaccard-known"))


def _numbered(full: DataFrame, ids: DataFrame) -> DataFrame:
    """``cid, n, hashes`` of the rows whose ``doc_id`` is listed; a short list is broadcast, counted first."""
    few = ids.limit(common.BROADCAST_IDS + 1).count() <= common.BROADCAST_IDS
    return full.join(F.broadcast(ids) if few else ids, "doc_id").select("cid", "n", "hashes")


def jaccard_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links``, one row per row of ``docs``.

    Two rows link when ``100 * |A & B| >= percent * |A | B|`` over their sets of ``size``-word shingles (words
    between white space, A-Z lower-cased; fewer words make one shingle). A null, empty or blank text has no
    shingles, links with nothing and is a component of its own. Equal texts link; repeated rows are rows of their
    own with one label, and link with what their text links with, no more; one ``doc_id`` on several texts is a row
    for each, linked as its text is. A row with a null ``doc_id`` has null as its component and links with nothing.
    Texts of any length are read whole. Other columns are ignored, and an empty table gives no rows.
    """
    linked_ = link_classes(docs, size, percent)
    known = linked_.known.select("cid", "component_id", "links")
    return lookup_left_join(linked_.members, known, ["cid"], HOT_ROWS).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "rep", "doc_id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("size", F.lit(1)) - 1).cast("long").alias("n_links"),
    )


def without_near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` but for near duplicates: of each component the row with the smallest id stays.

    Rows are dropped for their texts, never for their ids: where one ``doc_id`` stands on several texts, each of them
    is judged by itself, and of repeated rows that are to stay one does. Rows without words or without an id link with
    nothing and stay, repeated ones too.
    """
    linked_ = link_classes(docs, size, percent)
    known = linked_.known.select("cid", "root")
    judged = lookup_left_join(linked_.members.where("doc_id is not null"), known, ["cid"], HOT_ROWS)
    leads = (F.col("cid") == F.coalesce("root", "cid")) & (F.col("doc_id") == F.col("rep"))
    stays = F.col("cid").isNull() | leads
    per_id = judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_or(stays).alias("stays"))
    per_id = common.written(per_id.where("rows > 1 or not stays"), "near-duplicates")
    kept = common.with_bounded_side(docs, per_id.select("doc_id"), "doc_id", "left_anti")
    several = per_id.where("rows > 1").select("doc_id")
    if not several.limit(1).count():
        return kept.select(*docs.columns)
    # Ids on several rows: each row is judged by the class of its own text.
    rows = common.with_bounded_side(docs, several, "doc_id", "left_semi").select(*docs.columns)
    marks = [common.free_name(rows, name) for name in ("_n", "_s1", "_s2")]
    classed = _classed(rows, size, marks)
    worded = F.col(marks[0]) > 0
    leading = linked_.classes.join(known, "cid", "left").where(F.col("cid") == F.coalesce("root", "cid"))
    leading = leading.select(
        *[F.col(c).alias(m) for c, m in zip(("n", "s1", "s2"), marks, strict=True)], F.col("rep").alias("doc_id")
    )
    led = classed.where(worded).join(leading, [*marks, "doc_id"], "left_semi").dropDuplicates(marks)
    return kept.select(*docs.columns).unionAll(led.select(*docs.columns)).unionAll(
        classed.where(~worded).select(*docs.columns)
    )


def _classed(rows: DataFrame, size: int, names: list[str]) -> DataFrame:
    """``rows`` with the number of shingles and the two halves of the class of each text."""
    from pyspark.sql import types as T

    plain = [f"c{i}" for i in range(len(rows.columns))]
    at = next(i for i, c in enumerate(rows.columns) if c.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in common.sliced(batches, plain[at]):
            sets = [shingler(t) for t in batch.column(at).to_pylist()]
            halves = [shingler.class_of(s) for s in sets]
            found = [[len(s) for s in sets], [a for a, _ in halves], [b for _, b in halves]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(f, pa.int64()) for f in found]], names=[*plain, *names])

    frame = rows.toDF(*plain)
    schema = T.StructType([*frame.schema.fields, *[T.StructField(n, T.LongType()) for n in names]])
    return frame.mapInArrow(run, schema).toDF(*rows.columns, *names)
