"""Pipeline health score and the consolidated report row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import rules
from ..operators.frames import since_hours
from ..operators.series import mean_of_last


@dataclass(frozen=True)
class HealthPreset:
    """Which log rows count and what an empty validation log means."""

    window_hours: int | None
    alert_hours: int | None
    last_stages: int | None
    last_runs: int | None
    dq_warnings: bool
    default_dq: float


# Last 30 stages, alerts of a day, last 5 validations. H02: stages and alerts of a day, no warning
# term. H03: everything logged, no warning term, and no validation means no quality.
REPORT = HealthPreset(None, 24, 30, 5, True, 100.0)
SERVICE = HealthPreset(24, 24, None, 5, False, 100.0)
BOARD = HealthPreset(None, None, None, None, False, 0.0)


def health(
    stats: DataFrame, alerts: DataFrame, validation: DataFrame, preset: HealthPreset, as_of: Column | None = None
) -> DataFrame:
    """One row: counts, quality score, health score 0-100 and status."""
    as_of = F.current_timestamp() if as_of is None else as_of
    if preset.window_hours is not None:
        stats = since_hours(stats, "started_at", preset.window_hours, as_of)
    if preset.last_stages is not None:
        stats = stats.orderBy(F.col("started_at").desc(), "run_id", "stage_name").limit(preset.last_stages)
    if preset.alert_hours is not None:
        alerts = since_hours(alerts, "created_at", preset.alert_hours, as_of)
    if preset.last_runs is not None:
        quality = mean_of_last(
            validation, ["created_at", "run_identifier"], F.col("success_rate"), preset.last_runs, "dq"
        )
    else:
        quality = validation.agg(F.round(F.avg("success_rate"), 4).alias("dq"))

    failed = stats.agg(F.count_if(F.col("status") == "FAILED").alias("failed_stages"))
    alerted = alerts.agg(
        F.struct(
            F.count_if(F.col("alert_type") == "FAILURE").alias("failures"),
            F.count_if(F.col("alert_type") == "DQ_WARNING").alias("warnings"),
        ).alias("a")
    )
    counted = failed.withColumn("_a", alerted.scalar()).select(
        "failed_stages",
        F.col("_a.failures").alias("failure_alerts"),
        (F.col("_a.warnings") if preset.dq_warnings else F.lit(0).cast("long")).alias("dq_warnings"),
        F.coalesce(quality.scalar(), F.lit(preset.default_dq)).alias("dq_score"),
    )
    return counted.withColumn("health_score", health_score()).withColumn("health_status", health_status())


def health_score() -> Column:
    lost = (
        F.col("failed_stages") * fixed.HEALTH_PER_FAILED_STAGE
        + F.col("failure_alerts") * fixed.HEALTH_PER_FAILURE_ALERT
        + F.col("dq_warnings") * fixed.HEALTH_PER_DQ_WARNING
        + F.greatest(F.lit(0.0), (F.lit(fixed.HEALTH_DQ_TARGET) - F.col("dq_score")) * fixed.HEALTH_PER_DQ_POINT)
    )
    # Half points go to the even neighbour.
    return rules.clip(F.rint(F.lit(100) - lost), 0.0, 100.0).cast("int")


def health_status() -> Column:
    return rules.banded(F.col("health_score"), [(90, "HEALTHY"), (70, "WARNING")], "CRITICAL")


def consolidated_report(
    run_id: Column,
    health_row: DataFrame,
    forecast: DataFrame,
    fraud: DataFrame,
    churn: DataFrame,
    failures: DataFrame,
    *,
    sample: int = 3,
) -> DataFrame:
    """One row joining health, model verdicts and the first failing columns.

    ``failures`` is a top-k report, so collecting its first columns is bounded by ``sample``.
    """
    ranked = failures.orderBy(F.col("failure_count").desc(), "column_name", "expectation_type").limit(sample)
    worst = ranked.agg(
        F.array_join(
            F.transform(
                F.sort_array(
                    F.collect_list(F.struct((-F.col("failure_count")).alias("n"), "column_name", "expectation_type"))
                ),
                lambda x: x["column_name"],
            ),
            ", ",
        )
    )
    return health_row.select(
        run_id.alias("run_id"),
        "health_status",
        "health_score",
        "dq_score",
        forecast.select("mape").scalar().alias("forecast_mape"),
        fraud.select("fraud_rate_pct").scalar().alias("fraud_rate_pct"),
        fraud.select("verdict").scalar().alias("fraud_verdict"),
        churn.select("auc").scalar().alias("churn_auc"),
        churn.select("verdict").scalar().alias("churn_verdict"),
        worst.scalar().alias("top_failures"),
    )
