"""Run logs, alerts, rule results and score tables: roll-ups and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import ALERTS, RUN_STATS, enforce
from ..functions import fixed_values as fixed
from ..functions import rules
from ..functions.measures import milli_avg, rows, true_count, whole_avg
from ..operators.frames import mode_of, top
from ..operators.keyed import latest_run_rows

HIGH_RISK = ["HIGH", "CRITICAL"]


# -- pipeline runs ------------------------------------------------------------------------------------------

def run_rollup(stats: DataFrame, *, limit: int = 10) -> DataFrame:
    """One row per run, the last ``limit`` by start."""
    grouped = stats.groupBy("run_id").agg(
        F.min("started_at").alias("started"),
        F.max("started_at").alias("last_stage"),
        rows().alias("total_stages"),
        F.count_if(F.col("status") == "SUCCESS").alias("passed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum("duration_seconds").alias("total_duration_s"),
    )
    return top(grouped, limit, [F.col("started").desc()], ["run_id"])


def stage_durations(stats: DataFrame) -> DataFrame:
    """Mean and maximum duration per stage."""
    return stats.groupBy("stage_name").agg(
        whole_avg("duration_seconds", 4).alias("avg_duration"), F.max("duration_seconds").alias("max_duration")
    ).select(F.replace("stage_name", F.lit("_"), F.lit(" ")).alias("stage"), "avg_duration", "max_duration")


def run_kpis(stats: DataFrame) -> DataFrame:
    """Runs, mean stage duration, records and success rate."""
    return stats.agg(
        F.count_distinct("run_id").alias("runs"),
        whole_avg("duration_seconds", 4).alias("avg_duration"),
        F.sum("records_processed").alias("records"),
        F.round(F.count_if(F.col("status") == "SUCCESS") * 100 / rows(), 1).alias("success_pct"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null values by frequency."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("count"))
    return counted.orderBy(F.col("count").desc(), column)


def latest_run_stages(stats: DataFrame) -> DataFrame:
    """Stages of the run that started last."""
    last = stats.agg(F.max(F.struct("started_at", "run_id")).alias("r")).select("r.run_id").scalar()
    return stats.filter(F.col("run_id") == last).withColumn(
        "stage_name", F.replace("stage_name", F.lit("_"), F.lit(" "))
    )


def sla_breaches(stats: DataFrame, limit_seconds: int = fixed.SLA_SECONDS) -> DataFrame:
    """An alert row per stage that ran longer than allowed."""
    late = stats.filter(F.col("duration_seconds") > limit_seconds)
    message = F.format_string(f"SLA breach: %ds > {limit_seconds}s", "duration_seconds")
    return late.select("run_id", "stage_name", message.alias("error_message"), F.lit("DQ_WARNING").alias("alert_type"))


def first_failures(stats: DataFrame) -> DataFrame:
    """The first failed stage of each run as a FAILURE alert."""
    failed = stats.filter(F.col("status") == "FAILED").groupBy("run_id").agg(
        F.min(F.struct("started_at", "stage_name")).alias("first")
    )
    message = F.concat(F.lit("Run "), "run_id", F.lit(" FAILED at: "), F.col("first.stage_name"))
    return failed.select(
        "run_id",
        F.col("first.stage_name").alias("stage_name"),
        message.alias("error_message"),
        F.lit("FAILURE").alias("alert_type"),
    )


def stage_row(spark, run_id: str, stage: str, records: int, seconds: int, status: str = "SUCCESS") -> DataFrame:
    """A one-row run-stat frame, ready to append."""
    row = [(run_id, stage, records, seconds, status)]
    names = "run_id string, stage_name string, records_processed int, duration_seconds int, status string"
    return enforce(spark.createDataFrame(row, names), RUN_STATS)


def alert_rows(alerts: DataFrame, pipeline: str) -> DataFrame:
    """Alert rows of any origin in the alert table's contract, ready to append."""
    stamped = alerts.withColumn("pipeline_name", F.lit(pipeline)).withColumn("execution_date", F.current_timestamp())
    return enforce(stamped, ALERTS)


def alert_badge(alerts: DataFrame) -> DataFrame:
    """Failures, warnings and what the badge shows."""
    counted = alerts.agg(
        F.count_if(F.col("alert_type") == "FAILURE").alias("failures"),
        F.count_if(F.col("alert_type") == "DQ_WARNING").alias("warnings"),
    )
    badge = F.when(F.col("failures") > 0, "failure").when(F.col("warnings") > 0, "warning").otherwise("all clear")
    return counted.withColumn("badge", badge)


# -- rule results -----------------------------------------------------------------------------------------------

def rule_outcomes(details: DataFrame) -> DataFrame:
    """Passed and failed evaluations per rule, one row per rule and status."""
    wide = details.groupBy("expectation_type").agg(
        true_count("success").alias("passed"), F.count_if(~F.col("success")).alias("failed")
    )
    labelled = wide.withColumn("rule", rules.rule_label(F.col("expectation_type")))
    return labelled.unpivot(["expectation_type", "rule"], ["passed", "failed"], "status", "count")


def top_failures(failed: DataFrame, results: DataFrame, *, limit: int = 10) -> DataFrame:
    """Most frequent failing (column, rule) of the latest validation run, with a sample reason."""
    latest = latest_run_rows(failed, results, "run_identifier", "created_at")
    grouped = latest.groupBy("column_name", "expectation_type").agg(
        rows().alias("failure_count"), F.max("failed_reason").alias("sample_reason")
    )
    return top(grouped, limit, [F.col("failure_count").desc()], ["column_name", "expectation_type"])


def failed_columns(failed: DataFrame) -> DataFrame:
    """The failing columns as one ordered, comma-separated text."""
    names = failed.select("column_name").distinct()
    return names.agg(F.array_join(F.sort_array(F.collect_list("column_name")), ", ").alias("failed_cols"))


def quality_history(results: DataFrame) -> DataFrame:
    """Q14: runs in time order with their quality band."""
    return results.select(
        "run_identifier",
        "success_rate",
        rules.quality_band(F.col("success_rate")).alias("band"),
        "created_at",
    ).orderBy("created_at", "run_identifier")


def quality_gate(results: DataFrame, failed: DataFrame, threshold: float = fixed.DQ_GATE) -> DataFrame:
    """Q13: a DQ_WARNING row when the latest score is below the threshold; nothing otherwise."""
    latest = results.agg(F.max(F.struct("created_at", "run_identifier", "success_rate")).alias("r")).select("r.*")
    below = latest.filter(F.col("success_rate") < threshold)
    return below.select(
        F.col("run_identifier").alias("run_id"),
        F.lit("data_validation").alias("stage_name"),
        F.col("success_rate").alias("dq_score"),
        failed_columns(failed).scalar().alias("failed_cols"),
        F.lit("DQ_WARNING").alias("alert_type"),
    )


# -- score tables -------------------------------------------------------------------------------------------------

def fraud_by_label(scores: DataFrame, digits: int = 2) -> DataFrame:
    """A15."""
    grouped = scores.groupBy("risk_label").agg(
        rows().alias("count"), milli_avg("fraud_risk_score", digits).alias("avg_score")
    )
    return grouped.orderBy(F.col("avg_score").desc(), "risk_label")


def churn_by_risk(scores: DataFrame) -> DataFrame:
    """A16."""
    grouped = scores.groupBy("churn_risk").agg(
        rows().alias("customers"),
        milli_avg("churn_probability", 3).alias("avg_prob"),
        milli_avg("model_auc", 3).alias("model_auc"),
        true_count("is_high_value_customer").alias("high_value_at_risk"),
    )
    return grouped.orderBy(F.col("avg_prob").desc(), "churn_risk")


def fraud_hours(scores: DataFrame) -> DataFrame:
    """A44."""
    kept = scores.dropna(subset=["pickup_hour", "risk_label"])
    return kept.groupBy("pickup_hour", "risk_label").agg(rows().alias("count"))


def churn_by_tier(scores: DataFrame) -> DataFrame:
    """Mean probability and customers per loyalty tier."""
    kept = scores.dropna(subset=["loyalty_tier"])
    return kept.groupBy("loyalty_tier").agg(
        milli_avg("churn_probability", 4).alias("avg_prob"), F.count("churn_probability").alias("customers")
    )


def churn_funnel(scores: DataFrame) -> DataFrame:
    """Customers per risk in severity order."""
    counted = scores.filter(F.col("churn_risk").isNotNull()).groupBy("churn_risk").agg(rows().alias("count"))
    return counted.withColumn("position", rules.risk_rank(F.col("churn_risk"))).orderBy("position")


def forecast_highlights(forecast: DataFrame, *, head: int = 7) -> DataFrame:
    """Next day, mean of the first week, peak day (earliest on a tie) and peak value."""
    first = forecast.orderBy("forecast_date").limit(head)
    week = first.agg(F.round(F.avg("predicted_bookings"), 1).alias("v")).scalar()
    return forecast.agg(
        F.min_by("predicted_bookings", "forecast_date").alias("next_day"),
        F.max(F.struct("predicted_bookings", (-F.unix_date("forecast_date")).alias("_d"), "forecast_date")).alias("p"),
    ).select(
        "next_day",
        week.alias("next_7d_avg"),
        F.col("p.forecast_date").alias("peak_day"),
        F.round(F.col("p.predicted_bookings"), 0).alias("peak_value"),
    )


def risk_profile(fraud: DataFrame, churn: DataFrame) -> DataFrame:
    """Counts of risky rows, modal route of CRITICAL bookings, modal tier of high-risk customers."""
    critical = fraud.filter(F.col("risk_label") == "CRITICAL")
    at_risk = churn.filter(F.col("churn_risk").isin(HIGH_RISK))
    counted = fraud.agg(
        F.count_if(F.col("risk_label") == "CRITICAL").alias("fraud_critical"),
        F.count_if(F.col("risk_label") == "HIGH").alias("fraud_high"),
        rows().alias("fraud_scored"),
    )
    return counted.select(
        "*",
        mode_of(critical, "route").scalar().alias("top_fraud_route"),
        at_risk.agg(rows()).scalar().alias("churn_high_risk"),
        mode_of(at_risk, "loyalty_tier").scalar().alias("top_churn_tier"),
    )


def top_scored(
    scores: DataFrame, *, score: str, key: list[str], label: str, value: str | None = None, limit: int = 100
) -> DataFrame:
    """The highest scores, optionally of one label."""
    kept = scores if value is None else scores.filter(F.col(label) == value)
    return top(kept, limit, [F.col(score).desc()], key)


def top_critical(fraud: DataFrame, serving: DataFrame) -> DataFrame:
    """The highest-scored CRITICAL booking with its serving attributes.

    Only the winner is joined: the top row is taken from the score table alone, among bookings that the
    serving table has.
    """
    critical = fraud.filter(F.col("risk_label") == "CRITICAL").select("booking_id", "fraud_risk_score", "risk_label")
    known = critical.join(serving.select("booking_id"), "booking_id", "left_semi")
    winner = top(known, 1, [F.col("fraud_risk_score").desc()], ["booking_id"])
    attributes = [
        "customer_name", "route", "trip_type", "pickup_hour", "payment_method", "payment_amount",
        "is_split_payment", "car_segment", "loyalty_tier",
    ]
    joined = winner.join(serving.select("booking_id", "car_id", "payment_id", *attributes), "booking_id")
    picked = top(joined, 1, [F.col("payment_id").asc_nulls_last(), F.col("car_id").asc_nulls_last()], attributes)
    return picked.select("booking_id", "fraud_risk_score", "risk_label", *attributes)


# -- model evaluation ------------------------------------------------------------------------------------------------

def actual_against_forecast(daily: DataFrame, forecast: DataFrame) -> DataFrame:
    """``forecast_date, actual, predicted_bookings`` of the dates that both have; ``daily`` is ``(ds, y)``."""
    actual = daily.select(F.col("ds").alias("forecast_date"), F.col("y").alias("actual"))
    return actual.join(forecast.select("forecast_date", "predicted_bookings"), "forecast_date")


def forecast_evaluation(
    serving: DataFrame,
    forecast: DataFrame,
    *,
    as_of: Column,
    days: int = 30,
    retrain_mape: float = fixed.FORECAST_RETRAIN_MAPE,
) -> DataFrame:
    """M13 (with J07): actual against forecast by date over the last ``days``.

    A stored cross-validated error takes precedence over the error of the overlap.
    """
    recent = serving.filter(F.col("booking_date") >= F.date_sub(as_of, days))
    overlap = actual_against_forecast(recent.groupBy(F.col("booking_date").alias("ds")).agg(rows().alias("y")), forecast)
    error = F.abs(F.col("actual") - F.col("predicted_bookings")) / F.greatest(F.col("actual"), F.lit(1))
    measured = overlap.agg(rows().alias("eval_days"), F.round(F.avg(error) * 100, 2).alias("overlap_mape"))
    stored = forecast.agg(F.min_by("mape", F.when(F.col("mape").isNotNull(), F.col("forecast_date")))).scalar()
    final = F.coalesce(F.nullif(F.col("stored"), F.lit(0.0)), F.col("overlap_mape"))
    verdict = (
        F.when(F.col("mape") < fixed.FORECAST_GOOD_MAPE, "good")
        .when(F.col("mape") < retrain_mape, "acceptable")
        .otherwise("needs_retraining")
    )
    return (
        measured.withColumn("stored", stored)
        .select(
            F.when(F.col("eval_days") > 0, "success").otherwise("no_overlap").alias("status"),
            F.when(F.col("eval_days") > 0, F.round(final, 2)).alias("mape"),
            "eval_days",
        )
        .withColumn("accuracy", F.round(F.lit(100) - F.col("mape"), 1))
        .withColumn("verdict", F.when(F.col("mape").isNotNull(), verdict))
    )


def fraud_evaluation(
    scores: DataFrame,
    *,
    alert_pct: float = fixed.FRAUD_ALERT_PCT,
    monitor_pct: float = fixed.FRAUD_MONITOR_PCT,
) -> DataFrame:
    """M14."""
    counted = scores.agg(
        rows().alias("total_scored"),
        F.count_if(F.col("risk_label") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("risk_label") == "HIGH").alias("high_risk_count"),
    )
    risky = F.col("critical_count") + F.col("high_risk_count")
    rate = F.round(risky * 100 / F.greatest(F.col("total_scored"), F.lit(1)), 2)
    verdict = (
        F.when(F.col("fraud_rate_pct") > alert_pct, "alert")
        .when(F.col("fraud_rate_pct") > monitor_pct, "monitor")
        .otherwise("normal")
    )
    return counted.withColumn("fraud_rate_pct", rate).withColumn("verdict", verdict)


def churn_evaluation(scores: DataFrame, *, retrain_auc: float = fixed.CHURN_RETRAIN_AUC) -> DataFrame:
    """AUC of the latest scoring, share of high-risk customers, verdict."""
    counted = scores.agg(
        F.max(F.struct("created_at", "model_auc")).alias("latest"),
        rows().alias("total_scored"),
        F.count_if(F.col("churn_risk").isin(HIGH_RISK)).alias("high_risk_customers"),
    )
    auc = F.coalesce(F.col("latest.model_auc"), F.lit(0.0))
    verdict = (
        F.when(auc >= fixed.CHURN_GOOD_AUC, "good").when(auc >= retrain_auc, "acceptable").otherwise("needs_retraining")
    )
    return counted.select(
        F.round(auc, 3).alias("auc"),
        "high_risk_customers",
        "total_scored",
        F.round(
            F.col("high_risk_customers") * 100 / F.greatest(F.col("total_scored"), F.lit(1)), 2
        ).alias("churn_rate_pct"),
        verdict.alias("verdict"),
    )


def model_metrics(forecast: DataFrame, fraud: DataFrame, churn: DataFrame) -> DataFrame:
    """The three evaluations as rows of a metrics table: model, metric, value, verdict."""
    parts = [
        forecast.select(F.lit("demand_forecast").alias("model"), F.lit("mape").alias("metric"), F.col("mape").alias("value"), "verdict"),
        fraud.select(F.lit("fraud").alias("model"), F.lit("fraud_rate_pct").alias("metric"), F.col("fraud_rate_pct").alias("value"), "verdict"),
        churn.select(F.lit("churn").alias("model"), F.lit("auc").alias("metric"), F.col("auc").alias("value"), "verdict"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def needs_retrain(metrics: DataFrame, retrain_auc: float = fixed.CHURN_RETRAIN_AUC) -> DataFrame:
    """The classifier measurements that call for a retrain; empty when all models are healthy."""
    return metrics.filter((F.col("metric") == "auc") & (F.col("value") < retrain_auc))
