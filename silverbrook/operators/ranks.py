"""Ranks, prefix sums and rank statistics over a whole column without gathering it.

Rows are combined by value first, range-partitioned by it, and summed up within their partitions; what the driver sees
is one row of totals a partition. So a column of any size is ranked, and a value that a third of all rows share is one
row before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import staged
from .keyed import lookup_left_join

# A table of codes is broadcast up to so many entries, counted first; beyond that it is joined by key.
BROADCAST_CODES = 200_000


def with_prefix_sums(df: DataFrame, order: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``df`` with ``before_<m>`` for each of ``measures``: its sum over all rows that come before, by ``order``.

    Rows must be distinct in ``order``. Measures are whole numbers and must not be null.
    """
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    # Written once: the cut into ranges must not be drawn a second time.
    ranged = staged(ranged, "ranged")
    totals = ranged.groupBy("_part").agg(*[F.sum(m).alias(m) for m in measures]).orderBy("_part").collect()
    starts, base = [], dict.fromkeys(measures, 0)
    for row in totals:
        starts.append((row["_part"], *[base[m] for m in measures]))
        base = {m: base[m] + int(row[m]) for m in measures}
    schema = "_part int" + "".join(f", _start_{m} decimal(38,0)" for m in measures)
    offsets = df.sparkSession.createDataFrame([(p, *map(_decimal, rest)) for p, *rest in starts], schema)
    placed = ranged.join(F.broadcast(offsets), "_part")
    sums = [
        (F.coalesce(F.sum(m).over(own), F.lit(0)) + F.col(f"_start_{m}")).cast("decimal(38,0)").alias(f"before_{m}")
        for m in measures
    ]
    return placed.select(*df.columns, *sums)


def _decimal(value: int):
    from decimal import Decimal

    return Decimal(value)


def area_under_curve(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``tested, auc``: the exact area under the ROC curve, ties counted half (Mann-Whitney).

    ``label`` is 0 or 1; rows without a score or label are left out, NaN is the largest score. Scores are not thinned
    to thresholds: rows of one score are one group, and every group counts. ``auc`` is null where a class is missing.
    """
    known = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    groups = known.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("positives"), F.sum(1 - F.col(label).cast("long")).alias("negatives")
    )
    ranked = with_prefix_sums(groups, ["score"], ["negatives"])
    # Twice the pairs won, in whole numbers.
    won = F.col("positives") * (2 * F.col("before_negatives") + F.col("negatives"))
    summed = ranked.agg(F.sum(won).alias("won"), F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    pairs = F.col("p").cast("double") * F.col("n").cast("double")
    return summed.select(
        (F.coalesce("p", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("tested"),
        F.when(pairs > 0, F.col("won").cast("double") / 2 / pairs).alias("auc"),
    )


def dense_codes(df: DataFrame, columns: Sequence[str], *more: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """``name, value, code``: for each of the text ``columns`` its distinct values, numbered from 0 in their order.

    All columns are combined in one aggregate; a null value has no code. ``more`` are further frames, each with the
    columns it is read for. Written once.
    """

    def cells(frame: DataFrame, names: Sequence[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in names])
        return frame.select(F.explode(pairs).alias("cell")).select("cell.*")

    parts = [cells(frame, names) for frame, names in [(df, columns), *more]]
    values = reduce(DataFrame.unionByName, parts).filter(F.col("value").isNotNull())
    distinct = values.groupBy("name", "value").agg(F.lit(1).cast("bigint").alias("one"))
    ranked = with_prefix_sums(distinct, ["name", "value"], ["one"])
    first = ranked.groupBy("name").agg(F.min("before_one").alias("first"))
    coded = ranked.join(F.broadcast(first), "name")  # one row a column
    return staged(coded.select("name", "value", (F.col("before_one") - F.col("first")).cast("int").alias("code")), "codes")


def with_codes(df: DataFrame, codes: DataFrame, columns: dict[str, Column], suffix: str = "_code") -> DataFrame:
    """``df`` with a code for each named value; values without one get the number of known ones.

    ``columns`` maps names in ``codes`` to the values to look up. A column's codes are broadcast where there are few,
    counted first; otherwise its rows are joined by value, hot values spread.
    """
    sizes = {r["name"]: r["n"] for r in codes.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}

    def attach(frame: DataFrame, item: tuple[str, Column]) -> DataFrame:
        name, value = item
        own = codes.filter(F.col("name") == name).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        frame = frame.withColumn("_value", value)
        few = sizes.get(name, 0) <= BROADCAST_CODES
        joined = frame.join(F.broadcast(own), "_value", "left") if few else lookup_left_join(frame, own, ["_value"])
        code = F.coalesce("_code", F.lit(sizes.get(name, 0))).alias(f"{name}{suffix}")
        return joined.select(*[c for c in frame.columns if c != "_value"], code)

    return reduce(attach, columns.items(), df)
