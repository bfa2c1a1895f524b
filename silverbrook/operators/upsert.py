"""Insert-or-update by key for plain files, as one join-free-of-hot-keys plan.

``merged`` is pure DataFrame algebra: survivors of the target by anti join, plus the source, or where both have one row
per key the newer of the two by one window. The table layer (``sources.tables``) replaces the partitions it touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keyed import key_counts, newest_per_key


class DuplicateSourceKeys(ValueError):
    """The source holds several rows for one key, so the outcome of an update would be arbitrary."""


def unique_source(source: DataFrame, keys: Sequence[str], newest_first: Sequence[str] = ()) -> DataFrame:
    """The newest source row per key; without an order the largest row, so that reruns agree."""
    return newest_per_key(source, keys, newest_first)


def reject_duplicates(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source itself, or an error when a key repeats."""
    repeated = key_counts(source, keys).filter(F.col("n_rows") > 1).limit(1)
    if not repeated.isEmpty():
        raise DuplicateSourceKeys(f"source has several rows for one value of {list(keys)}")
    return source


def merged_newest(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], newest_first: Sequence[str] = ()
) -> DataFrame:
    """``merged`` of a target with one row per key and ``unique_source``, by one aggregate over the rows of both."""
    new = source.withColumn("_age", F.lit(1))
    if target is None:
        return unique_source(source, keys, newest_first)
    wanted = source.select(*target.columns).columns
    old = target.withColumn("_age", F.lit(0))
    both = new.unionByName(old, allowMissingColumns=True)
    return newest_per_key(both, keys, ["_age", *newest_first]).select(*wanted)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Target after updating matches and inserting the rest; null keys match null keys.

    ``unique`` says that neither side has two rows of one key. Then the newer of a key's rows, two at most, is picked by
    a window, which takes sides that are laid out by some of the keys as they are; a null-safe join shuffles both again.
    """
    if unique:
        new = source.select(*target.columns).withColumn("_age", F.lit(0))
        both = target.withColumn("_age", F.lit(1)).unionByName(new)
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_age"))
        return both.withColumn("_place", place).filter(F.col("_place") == 1).select(*target.columns)
    left, right = target.alias("t"), source.select(*keys).alias("s")
    match = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    untouched = left.join(right, match, "left_anti")
    return untouched.select(*target.columns).unionByName(source.select(*target.columns))
