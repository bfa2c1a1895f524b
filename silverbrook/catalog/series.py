"""Time-series queries: W*, M01."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frames as fr
from ..operators import series as sr
from ..operators.quantile import exact_quantile
from ..plans import monitoring as mon
from .base import register

EVENT_DAYS = "(SELECT CAST(ts AS DATE) AS ds, count(*) AS y FROM events GROUP BY 1)"


def band_sql(source: str) -> str:
    return f"""
SELECT ds, y, avg7, std7, round(avg7 + 2 * std7, 6) AS upper, round(greatest(avg7 - 2 * std7, 0), 6) AS lower,
       (y > round(avg7 + 2 * std7, 6) OR y < round(greatest(avg7 - 2 * std7, 0), 6)) AS anomaly
FROM (SELECT ds, y, round(avg(y) OVER w, 6) AS avg7, round(coalesce(stddev_samp(y) OVER w, 0), 6) AS std7
      FROM {source} WINDOW w AS (ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


register("m01_daily_series", lambda f: f.daily, "SELECT ds, y FROM f_daily")
register(
    "w01_rolling_mean",
    lambda f: sr.rolling_band(f.daily).select("ds", "y", "avg7"),
    f"SELECT ds, y, avg7 FROM ({band_sql('f_daily')})",
)
register(
    "w02_rolling_deviation",
    lambda f: sr.rolling_band(f.daily).select("ds", "y", "std7"),
    f"SELECT ds, y, std7 FROM ({band_sql('f_daily')})",
)
register("w03_volume_anomalies", lambda f: sr.rolling_band(f.daily), band_sql("f_daily"))
register(
    "w03_event_anomalies",
    lambda f: sr.rolling_band(
        sr.daily_counts(f.table("events").select(F.col("ts").cast("date").alias("d")), "d")
    ),
    band_sql(EVENT_DAYS),
)
register(
    "w04_low_volume_hours",
    lambda f: sr.low_volume(f.mart, "pickup_hour"),
    """SELECT pickup_hour, bookings, bookings < avg(bookings) OVER () * 0.3 AS anomaly FROM (
         SELECT pickup_hour, count(*) AS bookings FROM f_serving WHERE pickup_hour IS NOT NULL GROUP BY 1)""",
)
register(
    "w05_mean_of_last_runs",
    lambda f: sr.mean_of_last(f.results, ["created_at", "run_identifier"], F.col("success_rate"), 5, "dq_score"),
    """SELECT round(avg(success_rate), 4) AS dq_score FROM (
         SELECT * FROM f_results ORDER BY created_at DESC, run_identifier DESC LIMIT 5)""",
)
register(
    "w06_min_max_scale",
    lambda f: sr.min_max_risk(f.table("events").select("event_id", "value"), "value", "risk"),
    """SELECT event_id, value, greatest(0.0, least(100.0, round((value - hi) / (lo - hi + 1e-9) * 100, 2))) AS risk
       FROM events CROSS JOIN (SELECT CAST(min(value) AS DOUBLE) AS lo, CAST(max(value) AS DOUBLE) AS hi FROM events)""",
)
register(
    "w07_recent_stages",
    lambda f: fr.top(
        f.stats, fr.bounded(30, 1, 100), [F.col("started_at").desc()], ["run_id", "stage_name"]
    ).select("run_id", "stage_name", "status", "duration_seconds", "records_processed"),
    """SELECT run_id, stage_name, status, duration_seconds, records_processed FROM f_stats
       ORDER BY started_at DESC, run_id, stage_name LIMIT 30""",
)
register(
    "w07_recent_alerts",
    lambda f: fr.top(
        fr.since_hours(f.alerts, "created_at", fr.bounded(168, 1, 168), f.last_event), 50,
        [F.col("created_at").desc()], ["error_message"],
    ).select("alert_type", "stage_name", "error_message"),
    """SELECT alert_type, stage_name, error_message FROM f_alerts
       WHERE created_at >= (SELECT max(ts) FROM events) - INTERVAL 168 HOUR
       ORDER BY created_at DESC, error_message LIMIT 50""",
)
register(
    "w07_recent_validations",
    lambda f: fr.top(f.results, 10, [F.col("created_at").desc()], ["run_identifier"]).drop("created_at"),
    """SELECT run_identifier, total_expectations, passed_expectations, failed_expectations, success_rate,
              validation_status FROM f_results ORDER BY created_at DESC, run_identifier LIMIT 10""",
)
register(
    "w07_forecast_series",
    lambda f: f.forecast.drop("mape").orderBy("forecast_date"),
    "SELECT forecast_date, predicted_bookings FROM f_forecast ORDER BY forecast_date",
)
register(
    "w07_latest_run_stages",
    lambda f: mon.latest_run_stages(f.stats).select("run_id", "stage_name", "status", "duration_seconds"),
    """SELECT run_id, replace(stage_name, '_', ' ') AS stage_name, status, duration_seconds FROM f_stats
       WHERE run_id = (SELECT run_id FROM f_stats ORDER BY started_at DESC, run_id DESC LIMIT 1)""",
)
register(
    "w08_quantile_days",
    lambda f: sr.calendar_quantile(
        f.mart.select(F.date_diff(F.lit("2002-01-01").cast("date"), "booking_date").alias("days")), "days", 0.3
    ),
    """SELECT quantile_cont(date_diff('day', booking_date, DATE '2002-01-01'), 0.3) AS quantile FROM f_serving""",
)


def _payment_quantile(f):
    """The exact quantile as a row beside the number of payments it was taken over."""
    payments = f.payments.select("payment_amount")
    quantile = exact_quantile(payments, "payment_amount", 0.3)
    return payments.agg(F.count(F.lit(1)).alias("payments")).withColumn("quantile", F.round(F.lit(quantile), 6))


register(
    "w08_quantile_amount",
    _payment_quantile,
    """SELECT count(*) AS payments, round(quantile_cont(payment_amount, 0.3), 6) AS quantile FROM f_payments""",
)
