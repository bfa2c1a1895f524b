"""Exact nearest neighbours by cosine similarity.

One question is a projection and a bounded top-k: every task keeps its best k. A batch of questions is
sent to the tasks only after its size is checked; a larger batch is cut into blocks that meet blocks of
vectors, so neither side ever has to fit in one place. Both forms give the same rows.

Vectors without a direction take no part on either side: null ones, those of zeros, and those that hold nulls or
components that are not finite. A vector of another width than the question's has no similarity to it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_LIMIT = 1024
BLOCK_ROWS = 200_000
# Similarities held at once by a task: rows of a block are worked through in slices of so many pairs.
PAIRS = 4_000_000


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two numeric arrays, in double precision."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def has_direction(vector: Column) -> Column:
    """True for vectors that may be compared: not null, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, query: Sequence[float] | Column, k: int = 5, *, key: str, vector: str) -> DataFrame:
    """The ``k`` rows most similar to one query vector; ties go to the smaller key."""
    probe = query if isinstance(query, Column) else F.array(*[F.lit(float(x)) for x in query])
    # A question that is a subquery has to be a column of its own before array functions may use it.
    numbers = F.col(vector).cast("array<double>")
    asked = vectors.filter(has_direction(numbers)).withColumn("_probe", probe.cast("array<double>"))
    asked = asked.filter(has_direction(F.col("_probe")) & (F.size("_probe") == F.size(vector)))
    scored = asked.withColumn("similarity", F.round(cosine(F.col(vector), F.col("_probe")), 6)).drop("_probe")
    return scored.orderBy(F.col("similarity").desc(), F.col(key).asc()).limit(k)


def nearest_batch(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    key: str,
    vector: str,
    query_key: str,
    query_vector: str,
    query_limit: int = QUERY_LIMIT,
) -> DataFrame:
    """The ``k`` nearest rows for every query row: ``query_key, key, similarity, rank``."""
    v = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vec"))
    q = queries.select(F.col(query_key).alias("qid"), F.col(query_vector).cast("array<double>").alias("vec"))
    v, q = v.filter(has_direction(F.col("vec"))), q.filter(has_direction(F.col("vec")))
    kinds = (q.schema["qid"].dataType.simpleString(), v.schema["key"].dataType.simpleString())
    out = f"qid {kinds[0]}, key {kinds[1]}, similarity double"
    head = q.limit(query_limit + 1).toPandas()
    best = (
        _against_all(v, head, k, out)
        if len(head) <= query_limit
        else _block_by_block(v, q, k, out, query_limit)
    )
    order = Window.partitionBy("qid").orderBy(F.col("similarity").desc(), F.col("key").asc())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("qid").alias(query_key), F.col("key").alias(key), "similarity", "rank")


def _against_all(v: DataFrame, queries: pd.DataFrame, k: int, out: str) -> DataFrame:
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _best(queries, batch, k)

    return v.mapInPandas(search, out)


def _block_by_block(v: DataFrame, q: DataFrame, k: int, out: str, query_limit: int) -> DataFrame:
    n_q = max(1, -(-q.count() // query_limit))
    n_v = max(1, -(-v.count() // BLOCK_ROWS))
    place = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    left = v.withColumn("vb", place("key", n_v)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    right = q.withColumn("qb", place("qid", n_q)).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))))
    nothing = pd.DataFrame({"qid": [], "key": [], "similarity": []})

    def search(block: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([nothing, *_best(probes, block, k)]) if len(block) and len(probes) else nothing

    return left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(search, out)


def _best(probes: pd.DataFrame, block: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    """Best ``k`` rows of a block for each query, width by width, in slices of at most ``PAIRS`` similarities."""
    widths, asked = block["vec"].map(len), probes["vec"].map(len)
    for width in sorted(set(widths) & set(asked)):
        some = probes[asked == width]
        ids, matrix = some["qid"].to_numpy(), _unit(some["vec"])
        rows = block[widths == width]
        held = None
        for at in range(0, len(rows), max(1, PAIRS // len(ids))):
            part = rows.iloc[at : at + max(1, PAIRS // len(ids))]
            similarity = np.round(matrix @ _unit(part["vec"]).T, 6)
            best = _top(ids, part["key"].to_numpy(), similarity, k)
            held = best if held is None else _keep(pd.concat([held, best]), k)
        if held is not None:
            yield held


def _top(ids: np.ndarray, keys: np.ndarray, similarity: np.ndarray, k: int) -> pd.DataFrame:
    take = min(k, len(keys))
    cut = np.partition(similarity, len(keys) - take, axis=1)[:, len(keys) - take]
    q_at, v_at = np.nonzero(similarity >= cut[:, None])
    return _keep(pd.DataFrame({"qid": ids[q_at], "key": keys[v_at], "similarity": similarity[q_at, v_at]}), k)


def _keep(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first ``k`` of each query by (similarity, smaller key)."""
    ordered = found.sort_values(["qid", "similarity", "key"], ascending=[True, False, True])
    return ordered.groupby("qid", sort=False).head(k)


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype("float64")
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
