"""Exact interpolated quantile of an unbounded numeric column.

The built-in exact percentile keeps every distinct value in one task. Here the two neighbouring order
statistics are found digit by digit: values become order-preserving 64-bit keys, and each of four rounds
counts 16 bits of the remaining candidates. A round is one map-side combined aggregate with at most
65,536 groups, whatever the size or skew of the data.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 16
ROUNDS = 4
MONEY_SCALE = 100


def exact_quantile(df: DataFrame, value: str, q: float, scale: int = MONEY_SCALE) -> float | None:
    """The ``q`` quantile of ``value``, read as a whole number of ``1/scale`` units; null if there is none.

    The input is read once: rounds run over its kept value counts.
    """
    counted = value_counts(df.select(F.rint(F.col(value) * scale).cast("long").alias("key")))
    counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = counted.agg(F.sum("n")).first()[0]
        if n is None:
            return None
        rank = q * (n - 1)
        below, above = math.floor(rank), math.ceil(rank)
        low = order_statistic(counted, below)
        high = low if above == below else order_statistic(counted, above)
        return (low + (high - low) * (rank - below)) / scale
    finally:
        counted.unpersist()


def value_counts(keys: DataFrame) -> DataFrame:
    """Occurrences per non-null ``key``."""
    return keys.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def order_statistic(counted: DataFrame, rank: int) -> int:
    """The value at a 0-based rank of the long ``key`` with occurrences ``n``, without sorting."""
    # Flipping the sign bit makes unsigned digit order equal signed value order.
    flipped = counted.select(F.col("key").bitwiseXOR(F.lit(-(1 << 63)).cast("long")).alias("key"), "n")
    found = 0
    for level in range(ROUNDS):
        shift = 64 - DIGIT_BITS * (level + 1)
        digit, rank_before = _digit_at(_matching(flipped, found, level), shift, rank)
        found, rank = (found << DIGIT_BITS) | digit, rank - rank_before
    return found - (1 << 63)


def _matching(keys: DataFrame, prefix: int, level: int) -> DataFrame:
    if level == 0:
        return keys
    head = F.shiftrightunsigned("key", 64 - DIGIT_BITS * level)
    return keys.filter(head == F.lit(prefix))


def _digit_at(keys: DataFrame, shift: int, rank: int) -> tuple[int, int]:
    """The digit whose group holds the rank, and how many keys lie in smaller groups."""
    digit: Column = F.shiftrightunsigned("key", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1).cast("long"))
    counts = keys.groupBy(digit.alias("digit")).agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
    hit = counts.withColumn("upto", upto).filter(F.col("upto") > rank).orderBy("digit").first()
    return hit["digit"], hit["upto"] - hit["n"]
