"""Aggregate expressions shared by the marts.

Money is summed as whole cents in a long: exact, independent of the order rows arrive in, and kept in
the code-generated hash aggregate. ``9.2e16`` currency units fit before an overflow error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(value: Column | str) -> Column:
    return F.rint(_col(value) * 100).cast("long")


def money_sum(value: Column | str, digits: int = 2) -> Column:
    return F.round(F.sum(cents(value)) / F.lit(100.0), digits)


def money_avg(value: Column | str, digits: int = 2) -> Column:
    return F.round(F.sum(cents(value)) / F.lit(100.0) / F.count(_col(value)), digits)


def whole_avg(value: Column | str, digits: int = 2) -> Column:
    """Mean of an integer column from an exact long sum."""
    return F.round(F.sum(_col(value).cast("long")) / F.count(_col(value)), digits)


def milli_avg(value: Column | str, digits: int = 4, scale: float = 1e6) -> Column:
    """Mean of a fractional column from an exact sum of scaled whole numbers."""
    scaled = F.rint(_col(value) * scale).cast("long")
    return F.round(F.sum(scaled) / F.lit(scale) / F.count(_col(value)), digits)


def rows() -> Column:
    return F.count(F.lit(1))


def true_count(value: Column | str) -> Column:
    """How many rows hold true; zero, not null, when none does."""
    return F.count_if(F.coalesce(_col(value), F.lit(False)))
