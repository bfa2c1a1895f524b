"""Nearest neighbours along shifted Hilbert curves (operator 10).

Vectors are projected to a few dimensions by several random rotations; each projection, shifted by its own random
offset, is put on a Hilbert curve. Spark range-partitions every curve by key and cuts it into blocks of equal row
counts. A query looks at the blocks around its own place on every curve; neighbouring windows of all curves merge
and are ranked by exact distance on the original vectors.

Copies of one vector are one point of a curve: the point carries the smallest ids of its copies, which are the only
ones a ranking of k can name, so a vector that a third of all rows share weighs as much as any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

K = 10
QUERY_EVERY = 100
CURVES, DIMENSIONS, BITS = 8, 4, 10
#: Points and query points that meet in one task.
BLOCK, ASKED = 32_768, 2_048
#: Part of a curve a query's window covers, and points it covers at least. See ``search`` on choosing it.
WINDOW_SHARE, WINDOW_LEAST = 0.26, 4_096
SEED = 20_240_117


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer cells, rows of ``n`` coordinates below ``2 ** bits``.

    From the top bit down, a coordinate's bit either inverts the lower bits of the first coordinate or exchanges
    them with its own; the Gray code of the result, read bit by bit across coordinates, is the place.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for i in range(n):
            up = (x[i] >> np.uint64(bit)) & np.uint64(1) == 1
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=np.uint64)
    for bit in range(bits - 1, 0, -1):
        up = (x[n - 1] >> np.uint64(bit)) & np.uint64(1) == 1
        flip = np.where(up, flip ^ np.uint64((1 << bit) - 1), flip)
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


def curve_parameters(width: int, curves: int = CURVES, dimensions: int = DIMENSIONS, seed: int = SEED):
    """A projection with orthonormal rows and a shift in cells, for each curve."""
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(curves):
        rows, _ = np.linalg.qr(draw.standard_normal((width, min(dimensions, width))))
        out.append((rows, draw.random(min(dimensions, width))))
    return out


def cells_of(vectors: np.ndarray, rows: np.ndarray, shift: np.ndarray, centre: np.ndarray, scale: float, bits: int) -> np.ndarray:
    """Cells of projected vectors: four standard deviations to each side of the centre, the rest at the border."""
    projected = (vectors - centre) @ rows / scale
    spread = (projected + 4) / 8 * ((1 << bits) - 2) + shift
    return np.clip(spread, 0, (1 << bits) - 1).astype(np.int64)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part: one vector an id, finite, not zero, of the usual width."""
    v = F.col("embedding").cast("array<double>")
    fine = (
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
        & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    )
    rows = embeddings.where(fine).select("vec_id", v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    return rows.where(F.size("v") == (widths[0].w if widths else 0))


def _nearest(k: int, window: int):
    """Nearest points of one block for each query point whose window reaches into it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asked, points = pdf[pdf["asks"]], pdf[~pdf["asks"]].sort_values("place")
        out = {"q": [], "pid": [], "dist": []}
        if len(asked) and len(points):
            x, place = np.stack(points["v"].to_numpy()), points["place"].to_numpy()
            squares, pids = np.einsum("ij,ij->i", x, x), points["pid"].to_numpy()
            for q, at, v in zip(asked["pid"], asked["place"], asked["v"], strict=True):
                low, high = np.searchsorted(place, [at - window, at + window + 1])
                if low == high:
                    continue
                y = np.asarray(v)
                rough = squares[low:high] - 2 * (x[low:high] @ y)
                if high - low > k:
                    # The quick form only picks; its rounding gets a margin, and distances are measured anew.
                    cut = np.partition(rough, k - 1)[k - 1] + 1e-9 * (y @ y + squares[low:high].max())
                    near = low + np.flatnonzero(rough <= cut)
                else:
                    near = np.arange(low, high)
                dist = np.sqrt(((x[near] - y) ** 2).sum(axis=1))
                best = np.lexsort((pids[near], dist))[:k]
                out["q"].append(np.full(len(best), q))
                out["pid"].append(pids[near[best]])
                out["dist"].append(dist[best])
        return pd.DataFrame({n: np.concatenate(c) if c else [] for n, c in out.items()}).astype(
            {"q": "int64", "pid": "int64", "dist": "float64"}
        )

    return run


def search(
    embeddings: DataFrame,
    k: int = K,
    query_every: int = QUERY_EVERY,
    curves: int = CURVES,
    share: float = WINDOW_SHARE,
    least: int = WINDOW_LEAST,
) -> DataFrame:
    """The ``k`` nearest found for each query: ``query_id, rank, vec_id, score``; ``score`` is the Euclidean distance.

    Queries are rows whose ``vec_id`` is divisible by ``query_every``; candidates are all rows but the query's own.
    Rows without an id, and vectors that are null, zero, or hold null or non-finite components, take no part; nor do
    those of another width than most. Of several vectors under one id the smallest stands. Ties go to the smaller
    id. With fewer candidates than ``k`` all are returned; an empty table gives no rows. Other columns are ignored.

    ``share`` sets the recall and the cost: a window covers that part of each curve, wherever blocks are cut. For
    vectors in clusters a small part, or ``least`` alone, finds nearly all; for vectors without structure, like
    random directions in 64 dimensions, no order in few dimensions keeps neighbours together, and recall of 0.9
    takes windows over a good part of the table. The scale of the projections is fitted on all vectors.
    """
    rows = common.written(usable(embeddings), "vectors")
    spark = embeddings.sparkSession
    # Of the copies of a vector only the k + 1 smallest ids can be named: ranks are cut off before the shuffle.
    order = Window.partitionBy("v").orderBy("vec_id")
    named = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    asks = rows.where(F.col("vec_id") % query_every == 0)
    points = common.written(
        named.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("pid"))
        .join(asks.select("v", F.lit(True).alias("asks")).distinct(), "v", "left")
        .select("pid", "v", "ids", F.coalesce("asks", F.lit(False)).alias("asks")),
        "points",
    )
    shape = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("w")).first()
    total, width = shape.n, shape.w or 1
    stats = points.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.var_pop("x").alias("s"))
    stats = sorted(stats.collect())
    centre = np.array([r.m for r in stats] or [0.0])
    scale = float(np.sqrt(np.mean([r.s for r in stats] or [1.0]))) or 1.0
    parameters = curve_parameters(width, curves)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for c, (turn, shift) in enumerate(parameters):
                key = hilbert_keys(cells_of(x, turn, shift, centre, scale, BITS), BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), c, dtype=np.int32)), pa.array(key), *batch.columns],
                    names=["curve", "key", "pid", "v", "asks"],
                )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(at, at + n))],
                names=["curve", "key", "pid", "v", "asks", "part", "at"],
            )
            at += n

    kind = "curve int, key bigint, pid bigint, v array<double>, asks boolean"
    on_curves = points.select("pid", "v", "asks").mapInArrow(keys, kind)
    lines = on_curves.repartitionByRange("curve", "key", "pid").sortWithinPartitions("curve", "key", "pid")
    lines = common.written(lines.mapInArrow(numbered, f"{kind}, part int, at bigint"), "curves")
    # One row a partition.
    sizes = dict(lines.groupBy("part").count().collect())
    bases, base = [], 0
    for part in sorted(sizes):
        bases.append((part, base))
        base += sizes[part]
    window = max(least, int(share * total / 2))
    place = F.col("base") + F.col("at") - F.col("curve") * F.lit(total)
    lines = lines.join(F.broadcast(spark.createDataFrame(bases, "part int, base bigint")), "part")
    lines = lines.select("curve", place.alias("place"), "pid", "v", "asks")
    reach = F.sequence(
        F.floor(F.greatest(F.col("place") - window, F.lit(0)) / BLOCK),
        F.floor(F.least(F.col("place") + window, F.lit(max(total - 1, 0))) / BLOCK),
    )
    questions = lines.where("asks").withColumn("block", F.explode(reach))
    # Blocks that many queries reach meet them in slices.
    slices = questions.groupBy("curve", "block").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("slices"))
    asked = questions.join(slices, ["curve", "block"]).withColumn("slice", F.pmod(F.xxhash64("pid"), F.col("slices")).cast("int"))
    shown = lines.withColumn("block", F.floor(F.col("place") / BLOCK)).join(slices, ["curve", "block"])
    shown = shown.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumn("asks", F.lit(False))
    columns = ["curve", "block", "slice", "place", "pid", "v", "asks"]
    found = asked.select(columns).union(shown.select(columns)).groupBy("curve", "block", "slice").applyInPandas(
        _nearest(k + 1, window), "q bigint, pid bigint, dist double"
    )
    found = found.groupBy("q", "pid").agg(F.min("dist").alias("dist"))
    close = Window.partitionBy("q").orderBy("dist", "vec_id")
    ranked = (
        found.join(points.select("pid", "ids"), "pid")
        .select("q", "dist", F.explode("ids").alias("vec_id"))
        .withColumn("r", F.row_number().over(close))
        .where(F.col("r") <= k + 1)
        .groupBy("q")
        .agg(F.sort_array(F.collect_list(F.struct("dist", "vec_id"))).alias("near"))
    )
    queries = asks.join(points.select("v", F.col("pid").alias("q")), "v").select("vec_id", "q")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        queries.withColumnRenamed("vec_id", "query_id")
        .join(ranked, "q")
        .select("query_id", F.posexplode(others).alias("i", "x"))
        .select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.dist").alias("score"))
    )
