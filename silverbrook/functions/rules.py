"""Business rules as column expressions.

Every rule is built from four shapes - cleaned text, lower-inclusive bands, right-closed bands and
lookups - so that a new profile only supplies other tables from ``fixed_values``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


# -- shapes ---------------------------------------------------------------------------------------

def banded(value: Column, bands: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the highest band whose lower bound ``value`` reaches; null counts as below."""
    first, *rest = sorted(bands, reverse=True)
    chain = reduce(lambda c, b: c.when(value >= b[0], b[1]), rest, F.when(value >= first[0], first[1]))
    return chain.otherwise(below)


def right_closed(value: Column, bands: Sequence[tuple[float, str]], floor: float = 0.0) -> Column:
    """Label of the lowest band whose upper bound is not exceeded; outside all bands is null."""
    chain = F.when(value < floor, F.lit(None).cast("string"))
    return reduce(lambda c, b: c.when(value <= b[0], b[1]), sorted(bands), chain)


def lookup(value: Column, groups: Mapping[str, Sequence[str]], otherwise: Column | str) -> Column:
    """Label whose accepted inputs hold ``value``."""
    (label, members), *rest = groups.items()
    chain = F.when(value.isin(*members), label)
    chain = reduce(lambda c, g: c.when(value.isin(*g[1]), g[0]), rest, chain)
    return chain.otherwise(otherwise)


def flag(condition: Column) -> Column:
    """A condition that is never null."""
    return F.coalesce(condition, F.lit(False))


# -- text, casts, numbers ---------------------------------------------------------------------------

def clean(value: Column) -> Column:
    return F.trim(value)


def clean_lower(value: Column) -> Column:
    return F.lower(F.trim(value))


def safe_int(value: Column) -> Column:
    return value.try_cast("int")


def safe_double(value: Column) -> Column:
    return value.try_cast("double")


def safe_date(value: Column) -> Column:
    return F.try_to_date(value, "yyyy-MM-dd")


def money(value: Column) -> Column:
    return F.round(safe_double(value), 2)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to a range; null stays null (``greatest``/``least`` alone would skip it)."""
    bounded = value if low is None else F.greatest(value, F.lit(low))
    bounded = bounded if high is None else F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


# -- customer -----------------------------------------------------------------------------------------

def email_domain(email: Column) -> Column:
    at = F.lit("@")
    return F.when(F.contains(email, at), F.split_part(email, at, F.lit(2))).otherwise(fixed.UNKNOWN_DOMAIN)


def loyalty_tier(tier: Column) -> Column:
    return lookup(tier, {t: [t] for t in fixed.LOYALTY_RANK}, fixed.DEFAULT_LOYALTY_TIER)


def loyalty_rank(tier: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in fixed.LOYALTY_RANK.items() for x in pair])
    return F.coalesce(ranks[tier], F.lit(fixed.LOYALTY_RANK[fixed.DEFAULT_LOYALTY_TIER]))


def is_high_value(rank: Column) -> Column:
    return flag(rank >= fixed.HIGH_VALUE_RANK)


def points_tier(points: Column) -> Column:
    return banded(points, fixed.POINTS_BANDS, fixed.POINTS_BELOW)


# -- booking --------------------------------------------------------------------------------------------

def pickup_hour(clock: Column) -> Column:
    """24-hour value of ``h:mm AM|PM``; the markers are matched in upper case only."""
    hour = safe_int(F.regexp_extract(clock, fixed.CLOCK_PATTERN, 1))
    shift = (
        F.when(clock.contains("PM") & (hour != 12), 12)
        .when(clock.contains("AM") & (hour == 12), -12)
        .otherwise(0)
    )
    return F.try_add(hour, shift)


def pickup_slot(hour: Column) -> Column:
    start, end, label = fixed.PICKUP_SLOTS[0]
    chain = F.when((hour >= start) & (hour < end), label)
    for start, end, label in fixed.PICKUP_SLOTS[1:]:
        chain = chain.when((hour >= start) & (hour < end), label)
    return chain.otherwise(fixed.PICKUP_SLOT_ELSE)


def trip_type(pickup: Column, drop: Column) -> Column:
    return F.when(flag(pickup == drop), "local").otherwise("intercity")


def route(pickup: Column, drop: Column) -> Column:
    return F.concat(pickup, F.lit(fixed.ROUTE_ARROW), drop)


# -- car -----------------------------------------------------------------------------------------------

def price_tier(price: Column) -> Column:
    return banded(price, fixed.PRICE_BANDS, fixed.PRICE_BELOW)


def insurance_coverage(coverage: Column) -> Column:
    return lookup(F.lower(coverage), fixed.COVERAGE, fixed.COVERAGE_ELSE)


def has_full_insurance(coverage: Column) -> Column:
    return flag(coverage == "full")


def insurer_type(provider: Column) -> Column:
    return lookup(provider, fixed.INSURER_TYPES, fixed.INSURER_ELSE)


def car_segment(model: Column) -> Column:
    return lookup(model, fixed.CAR_SEGMENTS, fixed.SEGMENT_ELSE)


# -- payment -------------------------------------------------------------------------------------------

def payment_method(method: Column) -> Column:
    return lookup(F.lower(method), fixed.PAYMENT_METHODS, F.lower(method))


def is_digital(method: Column) -> Column:
    return flag(method.isin(*fixed.DIGITAL_METHODS))


def amount_tier(amount: Column) -> Column:
    return banded(amount, fixed.AMOUNT_BANDS, fixed.AMOUNT_BELOW)


# -- scores and display ----------------------------------------------------------------------------------

def fraud_risk_label(score: Column) -> Column:
    return right_closed(score, fixed.FRAUD_BANDS)


def churn_risk_label(probability: Column) -> Column:
    return right_closed(probability, fixed.CHURN_BANDS)


def risk_rank(label: Column) -> Column:
    """Position of a risk label in severity order, for sorting."""
    return F.array_position(F.array(*[F.lit(x) for x in fixed.RISK_LABELS]), label).cast("int") - 1


def quality_band(rate: Column) -> Column:
    return banded(rate, [(fixed.QUALITY_GOOD, "good"), (fixed.QUALITY_WARN, "warn")], "critical")


def null_status(null_count: Column, rows: Column) -> Column:
    share = null_count * 100 / rows
    return (
        F.when(share > fixed.NULL_CRITICAL_PCT, "critical")
        .when(null_count > 0, "warning")
        .otherwise("healthy")
    )


def rule_label(rule: Column) -> Column:
    """Readable rule name: known prefixes removed, underscores as spaces."""
    bare = reduce(lambda c, prefix: F.replace(c, F.lit(prefix), F.lit("")), fixed.RULE_PREFIXES, rule)
    return F.replace(bare, F.lit("_"), F.lit(" "))
