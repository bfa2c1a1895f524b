"""Mart queries: A01-A37."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import frames as fr
from ..plans import marts, sketches
from ..session import fresh_path
from .base import Frames, register

REVENUE0 = "round(CAST(sum(CAST(round(payment_amount * 100) AS BIGINT)) AS DOUBLE) / 100.0, 0)"
REVENUE2 = "coalesce(round(CAST(sum(CAST(round(payment_amount * 100) AS BIGINT)) AS DOUBLE) / 100.0, 2), 0)"


def avg_money(column: str, digits: int) -> str:
    return (
        f"round(CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / 100.0 / count({column}), {digits})"
    )


def avg_whole(column: str, digits: int) -> str:
    return f"round(CAST(sum(CAST({column} AS BIGINT)) AS DOUBLE) / count({column}), {digits})"


def true_count(column: str) -> str:
    return f"count(*) FILTER ({column})"


AVG0 = avg_money("payment_amount", 0)
AVG4 = avg_money("payment_amount", 4)
LAST_DAY = "(SELECT max(booking_date) FROM f_booking)"

register(
    "a01_kpi_summary",
    lambda f: marts.kpi_summary(f.mart),
    f"""SELECT count(*) AS total_bookings, count(DISTINCT customer_id) AS total_customers, {REVENUE0} AS total_revenue,
               {true_count('is_high_value_customer')} AS high_value_customers,
               {true_count('is_digital_payment')} AS digital_payments, count(DISTINCT route) AS unique_routes,
               count(DISTINCT car_segment) AS car_segments, count(DISTINCT model) AS car_models FROM f_serving""",
)
register(
    "a02_daily_trend",
    lambda f: marts.daily_trend(f.mart),
    f"""SELECT booking_date, count(*) AS bookings, {REVENUE0} AS revenue FROM f_serving GROUP BY booking_date""",
)
register(
    "a02_daily_trend_90d",
    lambda f: marts.daily_trend(f.mart, days=90, as_of=f.last_day),
    f"""SELECT booking_date, count(*) AS bookings, {REVENUE0} AS revenue FROM f_serving
        WHERE booking_date >= {LAST_DAY} - 90 GROUP BY booking_date""",
)
register(
    "a03_segments",
    lambda f: marts.segments(f.mart),
    f"SELECT car_segment, count(*) AS bookings, {AVG0} AS avg_payment FROM f_serving GROUP BY car_segment",
)
register(
    "a04_payment_methods",
    lambda f: marts.payment_methods(f.mart),
    f"""SELECT payment_method, count(*) AS bookings, {REVENUE0} AS revenue,
               {true_count('is_digital_payment')} AS digital_count FROM f_serving GROUP BY payment_method""",
)
register(
    "a05_loyalty",
    lambda f: marts.loyalty(f.mart),
    f"""SELECT loyalty_tier, count(*) AS bookings, {true_count('is_high_value_customer')} AS high_value,
               {avg_whole('loyalty_points', 0)} AS avg_points FROM f_serving GROUP BY loyalty_tier""",
)
register(
    "a06_top_routes",
    lambda f: marts.top_routes(f.mart),
    f"""SELECT route, count(*) AS bookings, {AVG0} AS avg_payment, count(DISTINCT trip_type) AS trip_types
        FROM f_serving GROUP BY route ORDER BY bookings DESC, route LIMIT 10""",
)
register(
    "a07_top_models",
    lambda f: marts.top_models(f.mart),
    f"""SELECT model, {REVENUE0} AS revenue FROM f_serving GROUP BY model
        ORDER BY revenue DESC NULLS LAST, model NULLS FIRST LIMIT 7""",
)
register(
    "a08_month_weekday",
    lambda f: marts.month_weekday(f.mart),
    """SELECT strftime(booking_date, '%b') AS month, dayname(booking_date) AS dow, count(*) AS bookings
       FROM f_serving GROUP BY 1, 2""",
)
register(
    "a09_trip_types",
    lambda f: marts.trip_types(f.mart),
    f"SELECT trip_type, count(*) AS bookings, {AVG0} AS avg_payment FROM f_serving GROUP BY trip_type",
)
register(
    "a10_busiest_hours",
    lambda f: marts.busiest_hours(f.mart),
    """SELECT pickup_hour, pickup_slot, count(*) AS bookings FROM f_serving GROUP BY 1, 2
       ORDER BY bookings DESC, pickup_hour, pickup_slot LIMIT 5""",
)
register(
    "a11_segment_prices",
    lambda f: marts.segment_prices(f.mart),
    f"""SELECT car_segment, count(*) AS bookings, {avg_money('price_per_day', 0)} AS avg_price, {REVENUE0} AS revenue
        FROM f_serving GROUP BY car_segment""",
)
register(
    "a12_payment_totals",
    lambda f: marts.payment_totals(f.mart),
    f"""SELECT payment_method, count(*) AS count, {REVENUE0} AS total,
               {true_count('is_digital_payment')} AS digital_count FROM f_serving GROUP BY payment_method""",
)
register(
    "a13_loyalty_value",
    lambda f: marts.loyalty_value(f.mart),
    f"""SELECT loyalty_tier, count(*) AS bookings, count(DISTINCT customer_id) AS customers,
               {avg_whole('loyalty_points', 0)} AS avg_points,
               {true_count('is_high_value_customer')} AS high_value_count, {AVG0} AS avg_payment
        FROM f_serving GROUP BY loyalty_tier""",
)
register(
    "a14_revenue_summary",
    lambda f: marts.revenue_summary(f.mart),
    f"""SELECT count(*) AS bookings, {REVENUE0} AS total_revenue, {AVG0} AS avg_booking,
               {true_count('is_digital_payment')} AS digital_payments FROM f_serving""",
)
register(
    "a17_inactive_customers",
    lambda f: marts.inactive_customers(f.booking, days=60, as_of=f.last_day),
    f"SELECT count(DISTINCT customer_id) AS inactive FROM f_booking WHERE booking_date < {LAST_DAY} - 60",
)
register(
    "a18_monthly_trend",
    lambda f: marts.monthly_trend(f.mart),
    f"""SELECT booking_year, booking_month, count(*) AS bookings, {REVENUE0} AS revenue FROM f_serving GROUP BY 1, 2""",
)
register(
    "a19_overall_summary",
    lambda f: marts.overall_summary(f.mart),
    f"""SELECT count(*) AS total_bookings, count(DISTINCT customer_id) AS unique_customers,
               count(DISTINCT route) AS unique_routes, {REVENUE0} AS total_revenue,
               {true_count('is_high_value_customer')} AS high_value_customers FROM f_serving""",
)
register(
    "a20_normal_pattern",
    lambda f: marts.normal_pattern(f.serving),
    f"""SELECT {AVG0} AS avg_payment, round(max(payment_amount), 0) AS max_payment,
               {avg_money('price_per_day', 0)} AS avg_price_per_day, {avg_whole('pickup_hour', 1)} AS avg_pickup_hour,
               count(DISTINCT route) AS unique_routes, {true_count('is_split_payment')} AS split_payment_count,
               {true_count('is_digital_payment')} AS digital_payment_count, count(*) AS total_bookings
        FROM f_serving""",
)
register(
    "a21_daily_distinct",
    lambda f: marts.daily_distinct(f.mart),
    f"""SELECT booking_date, count(DISTINCT booking_id) AS bookings, {REVENUE2} AS revenue FROM f_serving
        WHERE booking_date IS NOT NULL GROUP BY booking_date""",
)
register(
    "a22_amount_tiers",
    lambda f: marts.amount_tiers(f.mart),
    f"""SELECT amount_tier, count(booking_id) AS bookings, {REVENUE2} AS revenue FROM f_serving
        WHERE amount_tier IS NOT NULL GROUP BY amount_tier""",
)
register(
    "a23_models",
    lambda f: marts.models(f.mart),
    f"""SELECT model, count(booking_id) AS bookings, {REVENUE2} AS revenue, {avg_money('price_per_day', 4)} AS avg_price
        FROM f_serving WHERE model IS NOT NULL GROUP BY model""",
)
register(
    "a24_insurance_mix",
    lambda f: marts.insurance_mix(f.mart),
    f"""SELECT insurance_coverage, insurer_type, {REVENUE2} AS revenue FROM f_serving
        WHERE insurance_coverage IS NOT NULL AND insurer_type IS NOT NULL GROUP BY 1, 2""",
)
register(
    "a25_tier_by_method",
    lambda f: marts.tier_by_method(f.mart),
    f"""SELECT loyalty_tier, payment_method, {REVENUE2} AS revenue FROM f_serving
        WHERE loyalty_tier IS NOT NULL AND payment_method IS NOT NULL GROUP BY 1, 2""",
)
PIVOTED = ["cash", "credit_card", "debit_card", "upi"]
register(
    "a25_tier_by_method_pivot",
    lambda f: marts.tier_by_method(f.mart, pivot_on=PIVOTED),
    "SELECT loyalty_tier, "
    + ", ".join(
        "coalesce(round(CAST(sum(CAST(round(payment_amount * 100) AS BIGINT)) FILTER (payment_method = '"
        + m + f"') AS DOUBLE) / 100.0, 2), 0) AS {m}"
        for m in PIVOTED
    )
    + " FROM f_serving WHERE loyalty_tier IS NOT NULL AND payment_method IS NOT NULL GROUP BY 1",
)
register(
    "a26_price_histogram",
    lambda f: marts.price_histogram(f.mart),
    """SELECT b.bin, round(lo + w * (b.bin - 1), 6) AS lower_edge, round(lo + w * b.bin, 6) AS upper_edge,
              coalesce(n, 0) AS n
       FROM (SELECT CAST(unnest(range(1, 26)) AS INTEGER) AS bin) b
       CROSS JOIN (SELECT min(price_per_day) AS lo, (max(price_per_day) - min(price_per_day)) / 25 AS w FROM f_serving) e
       LEFT JOIN (SELECT CAST(least(floor((price_per_day - lo) / w) + 1, 25) AS INTEGER) AS bin, count(*) AS n
                  FROM f_serving CROSS JOIN (SELECT min(price_per_day) AS lo,
                       (max(price_per_day) - min(price_per_day)) / 25 AS w FROM f_serving)
                  WHERE price_per_day IS NOT NULL GROUP BY 1) c ON b.bin = c.bin""",
)
register(
    "a27_route_value",
    lambda f: marts.route_value(f.mart),
    f"""SELECT route, count(booking_id) AS bookings, {REVENUE2} AS revenue, {AVG4} AS avg_amount FROM f_serving
        WHERE route IS NOT NULL GROUP BY route ORDER BY bookings DESC, route LIMIT 10""",
)
register(
    "a28_trip_by_segment",
    lambda f: marts.trip_by_segment(f.mart),
    f"""SELECT trip_type, car_segment, count(booking_id) AS bookings, {REVENUE2} AS revenue FROM f_serving
        WHERE trip_type IS NOT NULL AND car_segment IS NOT NULL GROUP BY 1, 2""",
)
register(
    "a29_hour_by_weekday",
    lambda f: marts.hour_by_weekday(f.mart),
    """SELECT pickup_hour, dayname(booking_date) AS dow, count(booking_id) AS bookings FROM f_serving
       WHERE pickup_hour IS NOT NULL AND booking_date IS NOT NULL GROUP BY 1, 2""",
)
register(
    "a30_slot_value",
    lambda f: marts.slot_value(f.mart),
    f"""SELECT pickup_slot, count(payment_amount) AS bookings, {REVENUE2} AS revenue, {AVG4} AS avg FROM f_serving
        WHERE pickup_slot IS NOT NULL GROUP BY pickup_slot""",
)
register(
    "a31_route_by_tier",
    lambda f: marts.route_by_tier(f.mart),
    f"""SELECT route, amount_tier, count(booking_id) AS bookings, {REVENUE2} AS revenue FROM f_serving
        WHERE route IS NOT NULL AND amount_tier IS NOT NULL GROUP BY 1, 2
        ORDER BY bookings DESC, route, amount_tier LIMIT 20""",
)
register(
    "a32_route_kpis",
    lambda f: marts.route_kpis(f.mart),
    """SELECT count(DISTINCT route) AS unique_routes, count(DISTINCT trip_type) AS trip_types,
              (SELECT pickup_hour FROM f_serving WHERE pickup_hour IS NOT NULL GROUP BY 1
               ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour,
              (SELECT pickup_slot FROM f_serving WHERE pickup_slot IS NOT NULL GROUP BY 1
               ORDER BY count(*) DESC, 1 LIMIT 1) AS top_slot
       FROM f_serving""",
)
for _column in ("payment_method", "loyalty_tier"):
    register(
        f"a33_share_{_column}",
        lambda f, c=_column: marts.category_share(f.mart, c),
        f"""SELECT {_column}, bookings, round(bookings * 100.0 / sum(bookings) OVER (), 4) AS pct FROM (
              SELECT {_column}, count(booking_id) AS bookings FROM f_serving WHERE {_column} IS NOT NULL GROUP BY 1)""",
    )

PROFILED = [
    "booking_id", "customer_id", "car_id", "payment_amount", "route", "trip_type", "car_segment", "pickup_hour",
    "loyalty_tier", "payment_method", "drop_time",
]


def _profile_sql(body: str) -> str:
    return "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, {body.format(c=c)} FROM f_serving" for c in PROFILED)


register(
    "a34_null_profile",
    lambda f: fr.null_profile(f.mart, PROFILED),
    f"""SELECT column_name, null_count, round(null_count * 100.0 / n, 2) AS null_pct,
               CASE WHEN null_count * 100.0 / n > 5 THEN 'critical' WHEN null_count > 0 THEN 'warning'
                    ELSE 'healthy' END AS status
        FROM ({_profile_sql("count(*) - count({c}) AS null_count, count(*) AS n")})""",
)
register(
    "a35_duplicate_rate",
    lambda f: fr.duplicate_rate(f.mart, "booking_id"),
    """SELECT count(*) - count(DISTINCT booking_id) AS dup_count,
              round((count(*) - count(DISTINCT booking_id)) * 100.0 / count(*), 4) AS dup_rate FROM f_serving""",
)
register(
    "a36_freshness",
    lambda f: marts.freshness(f.mart),
    """SELECT strftime(booking_date, '%Y-%m') AS month, count(booking_id) AS records, max(booking_date) AS latest
       FROM f_serving WHERE booking_date IS NOT NULL GROUP BY 1""",
)
register(
    "a37_column_profile",
    lambda f: fr.column_profile(f.mart, PROFILED),
    f"""SELECT column_name, null_count, round(null_count * 100.0 / n, 2) AS null_pct, distinct_count
        FROM ({_profile_sql("count(*) - count({c}) AS null_count, count(*) AS n, count(DISTINCT {c}) AS distinct_count")})""",
)


# -- marts from stored sketches --------------------------------------------------------------------------------------
# Sums are exact; an estimate is compared with the exact count it stands for.
CLOSE = 0.03


def _stored(f: Frames) -> str:
    path = fresh_path(f.spark, "sketches")
    sketches.store(sketches.daily_sketches(f.mart), path)
    return path


def _close(found: DataFrame, exact: DataFrame, keys: list[str], counts: list[str], sums: list[str]) -> DataFrame:
    truth = exact.select(*[F.col(c).alias(f"_{c}") for c in [*keys, *counts]])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.lit(True))
    near = [(F.abs(F.col(c) - F.col(f"_{c}")) <= CLOSE * F.col(f"_{c}")).alias(f"{c}_close") for c in counts]
    return found.join(truth, same).select(*keys, *sums, *near)


KPI_COUNTS = ["total_customers", "unique_routes", "car_segments", "car_models"]
KPI_SUMS = ["total_bookings", "total_revenue", "high_value_customers", "digital_payments"]


def _kpi_sketched(f: Frames, days: int | None = None) -> DataFrame:
    """Headline numbers read from the stored sketches alone."""
    as_of = None if days is None else f.last_day
    found = sketches.kpi_summary(sketches.window(f.spark, _stored(f), days, as_of))
    recent = f.mart if days is None else f.mart.filter(F.col("booking_date") >= F.date_sub(f.last_day, days))
    return _close(found, marts.kpi_summary(recent), [], KPI_COUNTS, KPI_SUMS)


def _kpi_sql(where: str = "") -> str:
    return f"""SELECT count(*) AS total_bookings, {REVENUE0} AS total_revenue,
                      {true_count('is_high_value_customer')} AS high_value_customers,
                      {true_count('is_digital_payment')} AS digital_payments,
                      {", ".join(f"TRUE AS {c}_close" for c in KPI_COUNTS)} FROM f_serving {where}"""


register("a01_sketched", _kpi_sketched, _kpi_sql())
register("a01_sketched_90d", lambda f: _kpi_sketched(f, 90), _kpi_sql(f"WHERE booking_date >= {LAST_DAY} - 90"))
register(
    "a13_sketched",
    lambda f: _close(
        sketches.loyalty_value(sketches.window(f.spark, _stored(f))), marts.loyalty_value(f.mart), ["loyalty_tier"],
        ["customers"], ["bookings", "avg_points", "high_value_count", "avg_payment"],
    ),
    f"""SELECT loyalty_tier, count(*) AS bookings, {avg_whole('loyalty_points', 0)} AS avg_points,
               {true_count('is_high_value_customer')} AS high_value_count, {AVG0} AS avg_payment, TRUE AS customers_close
        FROM f_serving GROUP BY loyalty_tier""",
)
register(
    "a19_sketched",
    lambda f: _close(
        sketches.overall_summary(sketches.window(f.spark, _stored(f))), marts.overall_summary(f.mart), [],
        ["unique_customers", "unique_routes"], ["total_bookings", "total_revenue", "high_value_customers"],
    ),
    f"""SELECT count(*) AS total_bookings, {REVENUE0} AS total_revenue,
               {true_count('is_high_value_customer')} AS high_value_customers,
               TRUE AS unique_customers_close, TRUE AS unique_routes_close FROM f_serving""",
)
