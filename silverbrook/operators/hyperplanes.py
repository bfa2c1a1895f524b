"""Approximate nearest neighbours by random hyperplanes.

A hash table gives a vector one bit a hyperplane: on which side it lies. Vectors of a small angle agree in most bits, so
a question looks into the buckets of its own bits and, one after another, of those that differ where it lies nearest to
a hyperplane. Buckets meet by key in Spark, with their vectors; a bucket's candidates are cut to the best ``k`` of a
question where they meet, so no pair is shuffled, and the survivors of all tables are ranked by exact similarity. With ``tables * probes`` buckets of
``n / 2 ** bits`` vectors each, the work a question makes is stated by ``expected_candidates`` and grows with the table
only as far as ``bits`` is left unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .vectors import BLOCK_ROWS, QUERY_LIMIT, _best, has_direction

TABLES, BITS, PROBES, SEED = 24, 6, 12, 20_261


def hyperplanes(width: int, tables: int = TABLES, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Normals, ``(tables, bits, width)``; those of one table are orthogonal as far as the width allows."""
    draw = np.random.default_rng([seed, width])
    out = draw.standard_normal((tables, bits, width))
    if bits <= width:
        out = np.stack([np.linalg.qr(t.T)[0].T for t in out])
    return out


def buckets_of(vectors: np.ndarray, normals: np.ndarray, probes: int = 1) -> np.ndarray:
    """``(rows, tables, probes)`` bucket numbers: the own one first, then by how little a vector would have to move.

    Of the ways to flip bits, those of one and of two bits are ranked by the sum of squared distances to the planes.
    """
    tables, bits, _ = normals.shape
    side = np.einsum("nd,tbd->ntb", vectors, normals)
    weight = 1 << np.arange(bits)
    own = ((side > 0) * weight).sum(axis=2)
    if probes == 1:
        return own[:, :, None]
    cost = side**2
    pairs = [(a, b) for a in range(bits) for b in range(a + 1, bits)]
    flips = np.array([0, *weight, *[weight[a] + weight[b] for a, b in pairs]])
    moved = np.concatenate(
        [np.zeros((*own.shape, 1)), cost, *[(cost[:, :, a] + cost[:, :, b])[:, :, None] for a, b in pairs]], axis=2
    )
    order = np.argsort(moved, axis=2, kind="stable")[:, :, : min(probes, len(flips))]
    return own[:, :, None] ^ flips[order]


def expected_candidates(rows: int, tables: int = TABLES, bits: int = BITS, probes: int = PROBES) -> float:
    """Vectors a question meets, repeats counted, where hyperplanes split them evenly."""
    return rows * tables * probes / 2**bits


def _keyed(df: DataFrame, key: str, vector: str, name: str, tables: int, bits: int, probes: int, seed: int) -> DataFrame:
    """``cell, name, vec``: every bucket a row lies in or asks for, as ``table * 2 ** bits + bucket`` of its width."""
    kinds = (df.schema[key].dataType.simpleString(), df.schema[vector].dataType.simpleString())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby(batch["vec"].map(len)):
                found = buckets_of(np.stack(part["vec"].to_numpy()).astype(float), hyperplanes(width, tables, bits, seed), probes)
                cells = (found + (np.arange(tables) << bits)[None, :, None]) * 65_536 + width
                yield part.assign(cells=list(cells.reshape(len(part), -1)))[["id", "vec", "cells"]]

    some = df.select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    placed = some.mapInPandas(run, f"id {kinds[0]}, vec {kinds[1]}, cells array<bigint>")
    return placed.select(F.explode("cells").alias("cell"), F.col("id").alias(name), "vec")


def _blocks(asked: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the cells they share, cut into blocks of at most about ``BLOCK_ROWS`` rows: ``cell, _q, _v``."""
    def blocks(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias(name))

    # A row a bucket of each width.
    sizes = blocks(asked, "_n_q").join(blocks(placed, "_n_v"), "cell")

    def cut(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64(key), F.col(f"_n{own}")).cast("int").alias(own)
        spread = F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1)).alias(other)
        return side.join(sizes, "cell").select("cell", F.col(key), "vec", place, spread)

    return cut(asked, "qid", "_q", "_v"), cut(placed, "key", "_v", "_q")


def nearest_approximate(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    key: str,
    vector: str,
    query_key: str,
    query_vector: str,
    tables: int = TABLES,
    bits: int = BITS,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """The ``k`` nearest rows found for every query: ``query_key, key, similarity, rank``, as ``nearest_batch`` gives them.

    Similarities are exact; what may be missing is a neighbour that shares no probed bucket. Vectors without a
    direction take no part, and only vectors of one width meet. Keys must be unique on both sides. A bucket that holds
    much of the table, copies of one vector say, is cut into slices by the join.
    """
    left, right = _numbers(queries, query_vector), _numbers(vectors, vector)
    asked = _keyed(left, query_key, query_vector, "qid", tables, bits, probes, seed)
    placed = _keyed(right, key, vector, "key", tables, bits, 1, seed)
    nothing = pd.DataFrame({"qid": [], "key": [], "similarity": []})

    def search(some: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(block):
            return nothing
        parts = [some.iloc[at : at + QUERY_LIMIT] for at in range(0, len(some), QUERY_LIMIT)]
        return pd.concat([nothing, *[best for part in parts for best in _best(part, block, k)]])

    kinds = (left.schema[query_key].dataType.simpleString(), right.schema[key].dataType.simpleString())
    asked, placed = _blocks(asked, placed)
    cells = ["cell", "_q", "_v"]
    met = asked.groupBy(*cells).cogroup(placed.groupBy(*cells))
    best = met.applyInPandas(search, f"qid {kinds[0]}, key {kinds[1]}, similarity double")
    # A pair that meets in several buckets is one pair, combined map-side.
    pairs = best.groupBy("qid", "key").agg(F.max("similarity").alias("similarity"))
    order = Window.partitionBy("qid").orderBy(F.col("similarity").desc(), F.col("key").asc())
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("qid").alias(query_key), F.col("key").alias(key), "similarity", "rank")


def _numbers(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has a direction; floats stay as narrow as they are, other numbers become doubles."""
    doubles = F.col(vector).cast("array<double>")
    kept = df.filter(has_direction(doubles))
    return kept if df.schema[vector].dataType.simpleString() == "array<float>" else kept.withColumn(vector, doubles)


def recall(found: DataFrame, exact: DataFrame, query_key: str, key: str) -> DataFrame:
    """One row ``recall``: the share of exact neighbours that were found; null without any."""
    hit = found.select(query_key, key, F.lit(1).alias("hit"))
    joined = exact.select(query_key, key).join(hit, [query_key, key], "left")
    return joined.agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
