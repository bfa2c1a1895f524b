"""Monitoring, evaluation and health queries: A15, A16, A38-A48, H*, M13-M16, Q13, Q14."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frames as fr
from ..plans import health as hl
from ..plans import monitoring as mon
from .base import register


def avg_scaled(column: str, digits: int, scale: str = "1e6") -> str:
    return (
        f"round(CAST(sum(CAST(round({column} * {scale}) AS BIGINT)) AS DOUBLE) / {scale} / count({column}), {digits})"
    )


register(
    "a15_fraud_by_label",
    lambda f: mon.fraud_by_label(f.fraud),
    f"""SELECT risk_label, count(*) AS count, {avg_scaled('fraud_risk_score', 2)} AS avg_score
        FROM f_fraud GROUP BY risk_label""",
)
register(
    "a16_churn_by_risk",
    lambda f: mon.churn_by_risk(f.churn),
    f"""SELECT churn_risk, count(*) AS customers, {avg_scaled('churn_probability', 3)} AS avg_prob,
               {avg_scaled('model_auc', 3)} AS model_auc, count(*) FILTER (is_high_value_customer) AS high_value_at_risk
        FROM f_churn GROUP BY churn_risk""",
)
register(
    "a38_run_rollup",
    lambda f: mon.run_rollup(f.stats).select(
        "run_id", "total_stages", "passed", "failed", "total_duration_s",
        F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"),
        F.date_format("last_stage", "yyyy-MM-dd HH:mm:ss").alias("last_stage"),
    ),
    """SELECT run_id, count(*) AS total_stages, count(*) FILTER (status = 'SUCCESS') AS passed,
              count(*) FILTER (status = 'FAILED') AS failed, CAST(sum(duration_seconds) AS BIGINT) AS total_duration_s,
              strftime(min(started_at), '%Y-%m-%d %H:%M:%S') AS started,
              strftime(max(started_at), '%Y-%m-%d %H:%M:%S') AS last_stage
       FROM f_stats GROUP BY run_id ORDER BY min(started_at) DESC, run_id LIMIT 10""",
)
register(
    "a39_stage_durations",
    lambda f: mon.stage_durations(f.stats),
    """SELECT replace(stage_name, '_', ' ') AS stage,
              round(CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds), 4) AS avg_duration,
              max(duration_seconds) AS max_duration FROM f_stats GROUP BY stage_name""",
)
register(
    "a39_run_kpis",
    lambda f: mon.run_kpis(f.stats),
    """SELECT count(DISTINCT run_id) AS runs,
              round(CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds), 4) AS avg_duration,
              CAST(sum(records_processed) AS BIGINT) AS records,
              round(count(*) FILTER (status = 'SUCCESS') * 100.0 / count(*), 1) AS success_pct FROM f_stats""",
)
register(
    "a40_status_counts",
    lambda f: mon.value_counts(f.stats, "status"),
    "SELECT status, count(*) AS count FROM f_stats GROUP BY status",
)
register(
    "a41_rule_outcomes",
    lambda f: mon.rule_outcomes(f.details),
    """SELECT expectation_type, replace(replace(replace(expectation_type, 'expect_column_values_to_be_', ''),
              'expect_column_', ''), '_', ' ') AS rule, status, count FROM (
         SELECT expectation_type, 'passed' AS status, count(*) FILTER (success) AS count FROM f_details GROUP BY 1
         UNION ALL
         SELECT expectation_type, 'failed', count(*) FILTER (NOT success) FROM f_details GROUP BY 1)""",
)
TOP_FAILURES = """SELECT column_name, expectation_type, count(*) AS failure_count, max(failed_reason) AS sample_reason
FROM f_failed WHERE run_identifier =
  (SELECT run_identifier FROM f_results ORDER BY created_at DESC, run_identifier DESC LIMIT 1)
GROUP BY column_name, expectation_type ORDER BY failure_count DESC, column_name, expectation_type LIMIT 10"""
register("a42_top_failures", lambda f: mon.top_failures(f.failed, f.results), TOP_FAILURES)
register(
    "a43_failed_columns",
    lambda f: mon.failed_columns(f.failed),
    """SELECT string_agg(column_name, ', ' ORDER BY column_name) AS failed_cols
       FROM (SELECT DISTINCT column_name FROM f_failed)""",
)
register(
    "a44_fraud_hours",
    lambda f: mon.fraud_hours(f.fraud),
    """SELECT pickup_hour, risk_label, count(*) AS count FROM f_fraud
       WHERE pickup_hour IS NOT NULL AND risk_label IS NOT NULL GROUP BY 1, 2""",
)
register(
    "a45_churn_by_tier",
    lambda f: mon.churn_by_tier(f.churn),
    f"""SELECT loyalty_tier, {avg_scaled('churn_probability', 4)} AS avg_prob, count(churn_probability) AS customers
        FROM f_churn WHERE loyalty_tier IS NOT NULL GROUP BY loyalty_tier""",
)
register(
    "a45_churn_funnel",
    lambda f: mon.churn_funnel(f.churn),
    """SELECT churn_risk, count(*) AS count,
              CAST(CASE churn_risk WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END AS INTEGER)
                AS position
       FROM f_churn WHERE churn_risk IS NOT NULL GROUP BY churn_risk""",
)
register(
    "a46_forecast_highlights",
    lambda f: mon.forecast_highlights(f.forecast),
    """SELECT (SELECT predicted_bookings FROM f_forecast ORDER BY forecast_date LIMIT 1) AS next_day,
              (SELECT round(avg(predicted_bookings), 1) FROM
                 (SELECT predicted_bookings FROM f_forecast ORDER BY forecast_date LIMIT 7)) AS next_7d_avg,
              forecast_date AS peak_day, round(predicted_bookings, 0) AS peak_value
       FROM f_forecast ORDER BY predicted_bookings DESC, forecast_date LIMIT 1""",
)
register(
    "a47_risk_profile",
    lambda f: mon.risk_profile(f.fraud, f.churn),
    """SELECT count(*) FILTER (risk_label = 'CRITICAL') AS fraud_critical,
              count(*) FILTER (risk_label = 'HIGH') AS fraud_high, count(*) AS fraud_scored,
              (SELECT route FROM f_fraud WHERE risk_label = 'CRITICAL' AND route IS NOT NULL GROUP BY route
               ORDER BY count(*) DESC, route LIMIT 1) AS top_fraud_route,
              (SELECT count(*) FROM f_churn WHERE churn_risk IN ('HIGH', 'CRITICAL')) AS churn_high_risk,
              (SELECT loyalty_tier FROM f_churn WHERE churn_risk IN ('HIGH', 'CRITICAL') GROUP BY loyalty_tier
               ORDER BY count(*) DESC, loyalty_tier LIMIT 1) AS top_churn_tier
       FROM f_fraud""",
)
register(
    "a48_alert_badge",
    lambda f: mon.alert_badge(f.alerts),
    """SELECT count(*) FILTER (alert_type = 'FAILURE') AS failures, count(*) FILTER (alert_type = 'DQ_WARNING') AS warnings,
              CASE WHEN failures > 0 THEN 'failure' WHEN warnings > 0 THEN 'warning' ELSE 'all clear' END AS badge
       FROM f_alerts""",
)
register(
    "q13_quality_gate",
    lambda f: mon.quality_gate(f.results, f.failed, threshold=101.0),
    """SELECT run_identifier AS run_id, 'data_validation' AS stage_name, success_rate AS dq_score,
              (SELECT string_agg(column_name, ', ' ORDER BY column_name)
               FROM (SELECT DISTINCT column_name FROM f_failed)) AS failed_cols, 'DQ_WARNING' AS alert_type
       FROM (SELECT * FROM f_results ORDER BY created_at DESC, run_identifier DESC LIMIT 1) WHERE success_rate < 101""",
)
register(
    "q14_quality_history",
    lambda f: mon.quality_history(f.results).drop("created_at"),
    """SELECT run_identifier, success_rate, CASE WHEN success_rate >= 90 THEN 'good' WHEN success_rate >= 70 THEN 'warn'
              ELSE 'critical' END AS band FROM f_results""",
)
register(
    "h04_sla_breaches",
    lambda f: mon.sla_breaches(f.stats),
    """SELECT run_id, stage_name, 'SLA breach: ' || CAST(duration_seconds AS VARCHAR) || 's > 600s' AS error_message,
              'DQ_WARNING' AS alert_type FROM f_stats WHERE duration_seconds > 600""",
)
register(
    "h05_first_failures",
    lambda f: mon.first_failures(f.stats),
    """SELECT run_id, stage_name, 'Run ' || run_id || ' FAILED at: ' || stage_name AS error_message,
              'FAILURE' AS alert_type
       FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY started_at, stage_name) AS r
             FROM f_stats WHERE status = 'FAILED') WHERE r = 1""",
)

AS_OF = "(SELECT max(ts) FROM events)"


def health_sql(stats: str, alerts: str, dq: str, warnings: bool) -> str:
    counted = "count(*) FILTER (alert_type = 'DQ_WARNING')" if warnings else "0"
    return f"""
SELECT failed_stages, failure_alerts, CAST(dq_warnings AS BIGINT) AS dq_warnings, dq_score, health_score,
       CASE WHEN health_score >= 90 THEN 'HEALTHY' WHEN health_score >= 70 THEN 'WARNING' ELSE 'CRITICAL' END
         AS health_status
FROM (SELECT *, CAST(greatest(0, least(100, round_even(100 - 15 * failed_stages - 10 * failure_alerts
                - 5 * dq_warnings - greatest(0, (90 - dq_score) * 0.5), 0))) AS INTEGER) AS health_score
      FROM (SELECT count(*) FILTER (status = 'FAILED') AS failed_stages FROM ({stats}))
      CROSS JOIN (SELECT count(*) FILTER (alert_type = 'FAILURE') AS failure_alerts, {counted} AS dq_warnings
                  FROM ({alerts}))
      CROSS JOIN (SELECT round(avg(success_rate), 4) AS dq_score FROM ({dq})))"""


LAST_5 = "SELECT * FROM f_results ORDER BY created_at DESC, run_identifier DESC LIMIT 5"
LAST_30 = "SELECT * FROM f_stats ORDER BY started_at DESC, run_id, stage_name LIMIT 30"
DAY_ALERTS = f"SELECT * FROM f_alerts WHERE created_at >= {AS_OF} - INTERVAL 24 HOUR"
DAY_STATS = f"SELECT * FROM f_stats WHERE started_at >= {AS_OF} - INTERVAL 24 HOUR"
register(
    "h01_health_report",
    lambda f: hl.health(f.stats, f.alerts, f.results, hl.REPORT, f.last_event),
    health_sql(LAST_30, DAY_ALERTS, LAST_5, True),
)
register(
    "h02_health_service",
    lambda f: hl.health(f.stats, f.alerts, f.results, hl.SERVICE, f.last_event),
    health_sql(DAY_STATS, DAY_ALERTS, LAST_5, False),
)
register(
    "h03_health_board",
    lambda f: hl.health(f.stats, f.alerts, f.results, hl.BOARD),
    health_sql("SELECT * FROM f_stats", "SELECT * FROM f_alerts", "SELECT * FROM f_results", False),
)

FORECAST_EVAL = """
SELECT 'success' AS status, mape, eval_days, round(100 - mape, 1) AS accuracy,
       CASE WHEN mape < 15 THEN 'good' WHEN mape < 30 THEN 'acceptable' ELSE 'needs_retraining' END AS verdict
FROM (SELECT round(avg(abs(actual - predicted_bookings) / greatest(actual, 1)) * 100, 2) AS mape, count(*) AS eval_days
      FROM (SELECT booking_date AS d, count(*) AS actual FROM f_serving
            WHERE booking_date >= (SELECT max(booking_date) FROM f_booking) - 30 GROUP BY 1)
      JOIN f_forecast ON d = forecast_date)"""
FRAUD_EVAL = """
SELECT *, CASE WHEN fraud_rate_pct > 30 THEN 'alert' WHEN fraud_rate_pct > 15 THEN 'monitor' ELSE 'normal' END AS verdict
FROM (SELECT count(*) AS total_scored, count(*) FILTER (risk_label = 'CRITICAL') AS critical_count,
             count(*) FILTER (risk_label = 'HIGH') AS high_risk_count,
             round((critical_count + high_risk_count) * 100.0 / greatest(total_scored, 1), 2) AS fraud_rate_pct
      FROM f_fraud)"""
CHURN_EVAL = """
SELECT round(a, 3) AS auc, high_risk_customers, total_scored,
       round(high_risk_customers * 100.0 / greatest(total_scored, 1), 2) AS churn_rate_pct,
       CASE WHEN a >= 0.80 THEN 'good' WHEN a >= 0.70 THEN 'acceptable' ELSE 'needs_retraining' END AS verdict
FROM (SELECT (SELECT model_auc FROM f_churn ORDER BY created_at DESC, model_auc DESC LIMIT 1) AS a,
             count(*) AS total_scored, count(*) FILTER (churn_risk IN ('HIGH', 'CRITICAL')) AS high_risk_customers
      FROM f_churn)"""


def _forecast_eval(f):
    return mon.forecast_evaluation(f.mart, f.forecast, as_of=f.last_day)


register("m13_forecast_evaluation", _forecast_eval, FORECAST_EVAL)
register("m14_fraud_evaluation", lambda f: mon.fraud_evaluation(f.fraud), FRAUD_EVAL)
register("m15_churn_evaluation", lambda f: mon.churn_evaluation(f.churn), CHURN_EVAL)
METRICS_SQL = f"""
SELECT 'demand_forecast' AS model, 'mape' AS metric, mape AS value, verdict FROM ({FORECAST_EVAL}) UNION ALL
SELECT 'fraud', 'fraud_rate_pct', fraud_rate_pct, verdict FROM ({FRAUD_EVAL}) UNION ALL
SELECT 'churn', 'auc', auc, verdict FROM ({CHURN_EVAL})"""


def _metrics(f):
    return mon.model_metrics(_forecast_eval(f), mon.fraud_evaluation(f.fraud), mon.churn_evaluation(f.churn))


register("m16_model_metrics", _metrics, METRICS_SQL)
register(
    "m16_needs_retrain",
    lambda f: mon.needs_retrain(_metrics(f), retrain_auc=0.9),
    f"SELECT * FROM ({METRICS_SQL}) WHERE metric = 'auc' AND value < 0.9",
)
register(
    "h06_consolidated_report",
    lambda f: hl.consolidated_report(
        f.stats.agg(F.max("run_id")).scalar(),
        hl.health(f.stats, f.alerts, f.results, hl.REPORT, f.last_event),
        _forecast_eval(f),
        mon.fraud_evaluation(f.fraud),
        mon.churn_evaluation(f.churn),
        mon.top_failures(f.failed, f.results),
    ),
    f"""SELECT (SELECT max(run_id) FROM f_stats) AS run_id, health_status, health_score, dq_score,
               (SELECT mape FROM ({FORECAST_EVAL})) AS forecast_mape,
               (SELECT fraud_rate_pct FROM ({FRAUD_EVAL})) AS fraud_rate_pct,
               (SELECT verdict FROM ({FRAUD_EVAL})) AS fraud_verdict,
               (SELECT auc FROM ({CHURN_EVAL})) AS churn_auc, (SELECT verdict FROM ({CHURN_EVAL})) AS churn_verdict,
               (SELECT string_agg(column_name, ', ' ORDER BY failure_count DESC, column_name, expectation_type)
                FROM (SELECT * FROM ({TOP_FAILURES}) ORDER BY failure_count DESC, column_name, expectation_type LIMIT 3))
                 AS top_failures
        FROM ({health_sql(LAST_30, DAY_ALERTS, LAST_5, True)})""",
)
