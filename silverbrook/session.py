"""Central settings, session construction and the shared scratch area."""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
import zipfile
from dataclasses import dataclass, field, fields, replace
from pathlib import Path

from pyspark.sql import SparkSession

from .functions import fixed_values as fixed

CONFIG_VARIABLE = "SILVERBROOK_CONFIG"
DEFAULT_CONFIG_FILES = ("config/silverbrook.json", "silverbrook.json")


@dataclass(frozen=True)
class Thresholds:
    """Numbers the gates and verdicts compare against."""

    dq_gate: float = fixed.DQ_GATE
    sla_seconds: int = fixed.SLA_SECONDS
    churn_inactive_days: int = fixed.CHURN_INACTIVE_DAYS
    churn_retrain_auc: float = fixed.CHURN_RETRAIN_AUC
    fraud_alert_pct: float = fixed.FRAUD_ALERT_PCT
    fraud_monitor_pct: float = fixed.FRAUD_MONITOR_PCT
    forecast_retrain_mape: float = fixed.FORECAST_RETRAIN_MAPE


@dataclass(frozen=True)
class Settings:
    """Everything a deployment changes without touching code."""

    app_name: str = "silverbrook"
    lake_root: str = "lake"
    table_format: str = "parquet"
    brokers: str = "localhost:9092"
    topic: str = "bookings"
    starting_offsets: str = "earliest"
    metadata_max_age_ms: str = "5000"
    session_timeout_ms: str = "30000"
    serving_url: str = ""
    serving_table: str = "customer_booking_staging"
    serving_user: str = ""
    serving_password: str = ""
    serving_driver: str = ""
    thresholds: Thresholds = field(default_factory=Thresholds)
    spark: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None = None) -> "Settings":
        """Read a JSON settings file; unknown names are an error, missing ones keep defaults."""
        candidates = [path] if path else [os.environ.get(CONFIG_VARIABLE), *DEFAULT_CONFIG_FILES]
        found = next((c for c in candidates if c and Path(c).is_file()), None)
        if found is None:
            if path:
                raise FileNotFoundError(path)
            return cls()
        raw = json.loads(Path(found).read_text())
        limits = raw.pop("thresholds", {})
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(raw) - known)
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        return replace(cls(), **raw, thresholds=Thresholds(**limits))

    def table_path(self, layer: str, name: str) -> str:
        return f"{self.lake_root.rstrip('/')}/{layer}/{name}"

    def checkpoint_path(self, name: str) -> str:
        """Stream checkpoints live beside the tables, so a rebuilt driver resumes instead of replaying."""
        return f"{self.lake_root.rstrip('/')}/_checkpoints/{name}"


RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Consecutive joins on one key would otherwise veto the skew split of the first.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins whose partitions turn out small need no sort. A hash table cannot spill, and keys take many times their
    # compressed room in it, so partitions are no larger either.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(settings: Settings | None = None, master: str | None = None) -> SparkSession:
    """A session with adaptive execution on and this package on its workers; cluster sizing stays with the submitter."""
    settings = settings or Settings()
    builder = SparkSession.builder.appName(settings.app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **settings.spark}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_LOCAL_DIRS: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, so that functions find it on any executor."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="silverbrook-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings results and balance depend on, and the package itself, for sessions built elsewhere."""
    ship_package(spark)
    for key in RUNTIME:
        spark.conf.set(key, RUNTIME[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only where none is set and driver and executors are one process.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="silverbrook-")
    return _LOCAL_DIRS[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/silverbrook/{label}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` and the tree learners at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
