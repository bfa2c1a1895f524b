"""Filters, shares, distributions, profiles and top-k over any frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.measures import rows


def apply_filters(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """Equality filters; a null value or a column the frame lacks means no filter."""
    for name, value in (filters or {}).items():
        if value is not None and name in df.columns:
            df = df.filter(F.col(name) == value)
    return df


def filter_badge(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Rows kept and rows in total, counted in one pass."""
    keep = F.lit(True)
    for name, value in filters.items():
        if value is not None and name in df.columns:
            keep = keep & (F.col(name) == value)
    return df.agg(F.count_if(keep).alias("kept"), rows().alias("total")).withColumn(
        "active", F.col("kept") != F.col("total")
    )


def since_days(df: DataFrame, day: str, days: int, as_of: Column) -> DataFrame:
    """Rows dated within ``days`` of ``as_of``."""
    return df.filter(F.col(day) >= F.date_sub(as_of, days))


def since_hours(df: DataFrame, moment: str, hours: int, as_of: Column) -> DataFrame:
    """Rows stamped within ``hours`` of ``as_of``."""
    return df.filter(F.col(moment) >= as_of - F.make_interval(hours=F.lit(hours)))


def latest(df: DataFrame, column: str) -> Column:
    """The largest value of a column as a scalar subquery: the usual ``as_of`` of recorded data."""
    return df.agg(F.max(column)).scalar()


def top(df: DataFrame, n: int, by: Sequence[Column], ties: Sequence[str]) -> DataFrame:
    """First ``n`` rows by ``by``, ties broken by key columns, without a full sort."""
    return df.orderBy(*by, *[F.col(t).asc() for t in ties]).limit(n)


def bounded(n: int, low: int, high: int) -> int:
    if not low <= n <= high:
        raise ValueError(f"limit {n} is outside {low}..{high}")
    return n


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(column).dropna().distinct().orderBy(column)


def with_share(grouped: DataFrame, measure: str, name: str = "pct", digits: int = 4) -> DataFrame:
    """Share of the total per row of an aggregate.

    The total is a scalar subquery over the aggregate, not a window that would gather it in one task.
    """
    total = grouped.agg(F.sum(measure)).scalar()
    return grouped.withColumn(name, F.round(F.col(measure) * 100.0 / total, digits))


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value, the smallest on a tie, through counts rather than a value map."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("n"))
    return counted.orderBy(F.col("n").desc(), F.col(column).asc()).limit(1).select(column)


def histogram(df: DataFrame, column: str, bins: int = 25) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included.

    The top edge belongs to the last bin; a constant column has everything in the first.
    """
    value = F.col(column).cast("double")
    edges = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("e"))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    place = F.when(F.col("w") > 0, F.least(F.floor((F.col("v") - F.col("lo")) / F.col("w")) + 1, F.lit(bins)))
    counted = (
        df.select(value.alias("v"), edges.scalar().alias("e"))
        .filter(F.col("v").isNotNull())
        .select("v", F.col("e.lo").alias("lo"), width.alias("w"))
        .groupBy(F.coalesce(place, F.lit(1)).cast("int").alias("bin"))
        .agg(rows().alias("n"))
    )
    frame = edges.filter(F.col("e.lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), F.col("e.lo").alias("lo"), width.alias("w")
    )
    return frame.join(counted, "bin", "left").select(
        "bin",
        F.round(F.col("lo") + F.col("w") * (F.col("bin") - 1), 6).alias("lower_edge"),
        F.round(F.col("lo") + F.col("w") * F.col("bin"), 6).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count, share and status per column from one pass."""
    columns = [c for c in (columns or df.columns) if c in df.columns]
    counted = df.agg(rows().alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counted.unpivot("_rows", columns, "column_name", "null_count")
    return long.select(
        "column_name",
        "null_count",
        F.round(F.col("null_count") * 100 / F.col("_rows"), 2).alias("null_pct"),
        rules.null_status(F.col("null_count"), F.col("_rows")).alias("status"),
    )


def duplicate_rate(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, and their share (A35); null keys count as duplicates."""
    counted = df.agg(rows().alias("n"), F.count_distinct(F.col(key)).alias("keys"))
    extra = F.col("n") - F.col("keys")
    rate = F.when(F.col("n") > 0, F.round(extra * 100 / F.col("n"), 4)).otherwise(0.0)
    return counted.select(extra.alias("dup_count"), rate.alias("dup_rate"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Null count, null share and distinct count per column.

    Exact distinct counts come from value counts of the unpivoted frame, which combine map-side per
    column and value; ``approx=True`` replaces them by sketches in a single aggregate.
    """
    columns = list(columns or df.columns)
    if approx:
        measures = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.col(c).isNull()).alias("null_count"),
                rows().alias("n"),
                F.approx_count_distinct(c).alias("distinct_count"),
            )
            for c in columns
        ]
        profiled = df.agg(F.array(*measures).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    else:
        cells = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot(
            [], columns, "column_name", "value"
        )
        values = cells.groupBy("column_name", "value").agg(rows().alias("n"))
        profiled = values.groupBy("column_name").agg(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.sum("n").alias("n"),
            F.count("value").alias("distinct_count"),
        )
    return profiled.select(
        "column_name",
        "null_count",
        F.round(F.col("null_count") * 100 / F.col("n"), 2).alias("null_pct"),
        "distinct_count",
    )
