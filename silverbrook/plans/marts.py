"""Analytic marts over the serving table.

Every mart is ``mart(df, *, filters=None, ...) -> DataFrame``: optional equality filters, then one hash
aggregate. Marts that answered from SQL keep null keys; those that came from data-frame code drop them
(``drop_nulls``). Revenue repeats a payment for every car of its booking, as the published marts do; pass
a frame curated at booking grain to avoid that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import money_avg, money_sum, rows, true_count, whole_avg
from ..operators.frames import apply_filters, bounded, histogram, mode_of, since_days, top, with_share

Filters = Mapping[str, object] | None


def summarise(
    df: DataFrame,
    keys: Sequence[str | Column],
    measures: Mapping[str, Column],
    filters: Filters = None,
    drop_nulls: bool = False,
) -> DataFrame:
    df = apply_filters(df, filters)
    if drop_nulls:
        df = df.dropna(subset=[k for k in keys if isinstance(k, str)])
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def _by_volume(df: DataFrame, measure: str, *keys: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), *keys)


# -- request marts: null keys are a group ------------------------------------------------------------------

def kpi_summary(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """One row of headline numbers."""
    return summarise(
        df,
        [],
        {
            "total_bookings": rows(),
            "total_customers": F.count_distinct("customer_id"),
            "total_revenue": money_sum("payment_amount", 0),
            "high_value_customers": true_count("is_high_value_customer"),
            "digital_payments": true_count("is_digital_payment"),
            "unique_routes": F.count_distinct("route"),
            "car_segments": F.count_distinct("car_segment"),
            "car_models": F.count_distinct("model"),
        },
        filters,
    )


def daily_trend(
    df: DataFrame, *, days: int | None = None, as_of: Column | None = None, filters: Filters = None
) -> DataFrame:
    """Bookings and revenue per date, all dates or the last ``days`` (7 to 365) before ``as_of``."""
    if days is not None:
        as_of = F.current_date() if as_of is None else as_of
        df = since_days(df, "booking_date", bounded(days, 7, 365), as_of)
    measures = {"bookings": rows(), "revenue": money_sum("payment_amount", 0)}
    return summarise(df, ["booking_date"], measures, filters).orderBy("booking_date")


def segments(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A03."""
    measures = {"bookings": rows(), "avg_payment": money_avg("payment_amount", 0)}
    return _by_volume(summarise(df, ["car_segment"], measures, filters), "bookings", "car_segment")


def payment_methods(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A04."""
    measures = {
        "bookings": rows(),
        "revenue": money_sum("payment_amount", 0),
        "digital_count": true_count("is_digital_payment"),
    }
    return _by_volume(summarise(df, ["payment_method"], measures, filters), "bookings", "payment_method")


def loyalty(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A05."""
    measures = {
        "bookings": rows(),
        "high_value": true_count("is_high_value_customer"),
        "avg_points": whole_avg("loyalty_points", 0),
    }
    return _by_volume(summarise(df, ["loyalty_tier"], measures, filters), "bookings", "loyalty_tier")


def top_routes(df: DataFrame, *, limit: int = 10, filters: Filters = None) -> DataFrame:
    """Busiest routes, 1 to 50 of them."""
    limit = bounded(limit, 1, 50)
    measures = {
        "bookings": rows(),
        "avg_payment": money_avg("payment_amount", 0),
        "trip_types": F.count_distinct("trip_type"),
    }
    grouped = summarise(df, ["route"], measures, filters)
    return top(grouped, limit, [F.col("bookings").desc()], ["route"])


def top_models(df: DataFrame, *, limit: int = 7, filters: Filters = None) -> DataFrame:
    """A07."""
    grouped = summarise(df, ["model"], {"revenue": money_sum("payment_amount", 0)}, filters)
    return top(grouped, limit, [F.col("revenue").desc()], ["model"])


def month_weekday(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """Heat map of month name by weekday, over all years."""
    keys = [
        F.date_format("booking_date", "MMM").alias("month"),
        F.date_format("booking_date", "EEEE").alias("dow"),
    ]
    return summarise(df, keys, {"bookings": rows()}, filters)


def trip_types(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A09."""
    measures = {"bookings": rows(), "avg_payment": money_avg("payment_amount", 0)}
    return _by_volume(summarise(df, ["trip_type"], measures, filters), "bookings", "trip_type")


def busiest_hours(df: DataFrame, *, limit: int = 5, filters: Filters = None) -> DataFrame:
    """A10."""
    grouped = summarise(df, ["pickup_hour", "pickup_slot"], {"bookings": rows()}, filters)
    return top(grouped, limit, [F.col("bookings").desc()], ["pickup_hour", "pickup_slot"])


def segment_prices(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """The two published segment answers (mean day price, revenue) side by side."""
    measures = {
        "bookings": rows(),
        "avg_price": money_avg("price_per_day", 0),
        "revenue": money_sum("payment_amount", 0),
    }
    return _by_volume(summarise(df, ["car_segment"], measures, filters), "bookings", "car_segment")


def payment_totals(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A12."""
    measures = {
        "count": rows(),
        "total": money_sum("payment_amount", 0),
        "digital_count": true_count("is_digital_payment"),
    }
    return _by_volume(summarise(df, ["payment_method"], measures, filters), "count", "payment_method")


def loyalty_value(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """Rows and distinct customers per tier, points, high-value rows and mean payment."""
    measures = {
        "bookings": rows(),
        "customers": F.count_distinct("customer_id"),
        "avg_points": whole_avg("loyalty_points", 0),
        "high_value_count": true_count("is_high_value_customer"),
        "avg_payment": money_avg("payment_amount", 0),
    }
    return _by_volume(summarise(df, ["loyalty_tier"], measures, filters), "avg_payment", "loyalty_tier")


def revenue_summary(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A14."""
    measures = {
        "bookings": rows(),
        "total_revenue": money_sum("payment_amount", 0),
        "avg_booking": money_avg("payment_amount", 0),
        "digital_payments": true_count("is_digital_payment"),
    }
    return summarise(df, [], measures, filters)


def inactive_customers(df: DataFrame, *, days: int, as_of: Column, filters: Filters = None) -> DataFrame:
    """Customers with a booking older than ``days`` before ``as_of``."""
    old = apply_filters(df, filters).filter(F.col("booking_date") < F.date_sub(as_of, days))
    return old.agg(F.count_distinct("customer_id").alias("inactive"))


def monthly_trend(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A18."""
    keys = ["booking_year", "booking_month"]
    measures = {"bookings": rows(), "revenue": money_sum("payment_amount", 0)}
    return summarise(df, keys, measures, filters).orderBy(*keys)


def overall_summary(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A19."""
    measures = {
        "total_bookings": rows(),
        "unique_customers": F.count_distinct("customer_id"),
        "unique_routes": F.count_distinct("route"),
        "total_revenue": money_sum("payment_amount", 0),
        "high_value_customers": true_count("is_high_value_customer"),
    }
    return summarise(df, [], measures, filters)


def normal_pattern(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """What an ordinary booking looks like."""
    measures = {
        "avg_payment": money_avg("payment_amount", 0),
        "max_payment": F.round(F.max("payment_amount"), 0),
        "avg_price_per_day": money_avg("price_per_day", 0),
        "avg_pickup_hour": whole_avg("pickup_hour", 1),
        "unique_routes": F.count_distinct("route"),
        "split_payment_count": true_count("is_split_payment"),
        "digital_payment_count": true_count("is_digital_payment"),
        "total_bookings": rows(),
    }
    return summarise(df, [], measures, filters)


# -- explorer marts: rows with a null key are left out, COUNT skips null booking ids ----------------------------

def _explore(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], filters: Filters) -> DataFrame:
    return summarise(df, keys, measures, filters, drop_nulls=True)


def _volume() -> Column:
    return F.count("booking_id")


def _revenue() -> Column:
    """A sum that is zero, not null, over nothing, like the data-frame sum it stands for."""
    return F.coalesce(money_sum("payment_amount", 2), F.lit(0.0))


def freshness(df: DataFrame) -> DataFrame:
    """Records and the latest day of each month; rows without a date belong to none."""
    dated = df.filter(F.col("booking_date").isNotNull())
    return dated.groupBy(F.date_format("booking_date", "yyyy-MM").alias("month")).agg(
        F.count("booking_id").alias("records"), F.max("booking_date").alias("latest")
    )


def daily_distinct(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A21."""
    return _explore(df, ["booking_date"], {"bookings": F.count_distinct("booking_id"), "revenue": _revenue()}, filters)


def amount_tiers(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A22."""
    return _explore(df, ["amount_tier"], {"bookings": _volume(), "revenue": _revenue()}, filters)


def models(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A23."""
    measures = {"bookings": _volume(), "revenue": _revenue(), "avg_price": money_avg("price_per_day", 4)}
    return _explore(df, ["model"], measures, filters)


def insurance_mix(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A24."""
    return _explore(df, ["insurance_coverage", "insurer_type"], {"revenue": _revenue()}, filters)


def tier_by_method(
    df: DataFrame, *, filters: Filters = None, pivot_on: Sequence[str] | None = None
) -> DataFrame:
    """Revenue per tier and method; ``pivot_on`` lists methods to spread into columns."""
    if pivot_on is None:
        return _explore(df, ["loyalty_tier", "payment_method"], {"revenue": _revenue()}, filters)
    kept = apply_filters(df, filters).dropna(subset=["loyalty_tier", "payment_method"])
    return kept.groupBy("loyalty_tier").pivot("payment_method", list(pivot_on)).agg(_revenue())


def price_histogram(df: DataFrame, *, bins: int = 25, filters: Filters = None) -> DataFrame:
    """A26."""
    return histogram(apply_filters(df, filters), "price_per_day", bins)


def route_value(df: DataFrame, *, limit: int = 10, filters: Filters = None) -> DataFrame:
    """A27."""
    measures = {"bookings": _volume(), "revenue": _revenue(), "avg_amount": money_avg("payment_amount", 4)}
    return top(_explore(df, ["route"], measures, filters), limit, [F.col("bookings").desc()], ["route"])


def trip_by_segment(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A28."""
    return _explore(df, ["trip_type", "car_segment"], {"bookings": _volume(), "revenue": _revenue()}, filters)


def hour_by_weekday(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """A29."""
    dated = df.withColumn("dow", F.date_format("booking_date", "EEEE"))
    return _explore(dated, ["pickup_hour", "dow"], {"bookings": _volume()}, filters)


def slot_value(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """The count is of payments, not of rows."""
    measures = {
        "bookings": F.count("payment_amount"),
        "revenue": _revenue(),
        "avg": money_avg("payment_amount", 4),
    }
    return _explore(df, ["pickup_slot"], measures, filters)


def route_by_tier(df: DataFrame, *, limit: int = 20, filters: Filters = None) -> DataFrame:
    """A31."""
    keys = ["route", "amount_tier"]
    grouped = _explore(df, keys, {"bookings": _volume(), "revenue": _revenue()}, filters)
    return top(grouped, limit, [F.col("bookings").desc()], keys)


def route_kpis(df: DataFrame, *, filters: Filters = None) -> DataFrame:
    """Distinct routes and trip types, peak hour and slot (smallest on a tie)."""
    kept = apply_filters(df, filters)
    counted = kept.agg(
        F.count_distinct("route").alias("unique_routes"), F.count_distinct("trip_type").alias("trip_types")
    )
    return counted.select(
        "*",
        mode_of(kept, "pickup_hour").scalar().alias("peak_hour"),
        mode_of(kept, "pickup_slot").scalar().alias("top_slot"),
    )


def category_share(df: DataFrame, category: str, *, filters: Filters = None) -> DataFrame:
    """Bookings per category with their share of the total."""
    grouped = _explore(df, [category], {"bookings": _volume()}, filters)
    return with_share(grouped, "bookings").orderBy(F.col("pct").desc(), category)


def report(df: DataFrame, marts: Sequence[str], **arguments) -> dict[str, DataFrame]:
    """Several marts of one serving frame; persist ``df`` first if they are all to be run."""
    return {name: globals()[name](df, **arguments) for name in marts}
