"""Seconds per headline query: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``; one JSON line on stdout.

The serving table is built once and written, as a deployment would; marts then read it. Every query is run
once to warm up and then ``BENCH_RUNS`` times (default 2), and the median counts. Results are consumed in
full by the no-op sink, so nothing is pruned and nothing goes through the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from silverbrook.catalog import QUERIES  # noqa: E402
from silverbrook.catalog.base import Frames  # noqa: E402
from silverbrook.operators import frames as fr  # noqa: E402
from silverbrook.operators import series as sr  # noqa: E402
from silverbrook.plans import marts, quality  # noqa: E402
from silverbrook.plans.scoring import churn, features  # noqa: E402
from silverbrook.sources import bridge, events, tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

SUITE = quality.suite(quality.booking_suite())
# Marts over the written serving table.
ON_SERVING = {
    "a01_kpi_summary": marts.kpi_summary,
    "a02_daily_trend": marts.daily_trend,
    "a03_segments": marts.segments,
    "a04_payment_methods": marts.payment_methods,
    "a06_top_routes": marts.top_routes,
    "a08_month_weekday": marts.month_weekday,
    "a13_loyalty_value": marts.loyalty_value,
    "a20_normal_pattern": marts.normal_pattern,
    "a21_daily_distinct": marts.daily_distinct,
    "a26_price_histogram": marts.price_histogram,
    "a31_route_by_tier": marts.route_by_tier,
    "a32_route_kpis": marts.route_kpis,
    "a33_share": lambda df: marts.category_share(df, "payment_method"),
    "a34_null_profile": fr.null_profile,
    "a37_column_profile": fr.column_profile,
    "w03_volume_anomalies": lambda df: sr.rolling_band(sr.daily_counts(df)),
    "w04_low_volume_hours": lambda df: sr.low_volume(df, "pickup_hour"),
    "q09_run_suite": lambda df: quality.run_suite(df, SUITE),
    "q12_quarantine": lambda df: quality.quarantine(df, SUITE, "bench"),
    "m04_category_codes": lambda df: features.with_codes(
        df, features.fit_codes(df, features.CATEGORIES), features.CATEGORIES
    ),
    "m07_churn_labels": lambda df: churn.label_churn(df, F.lit("2001-09-01").cast("date")),
}
# Queries from the raw tables.
FROM_RAW = [
    "j01_newest_per_key", "j04_serving_table", "j05_payment_counts", "j09_upsert_single_key", "j10_upsert_composite_key",
    "j12_duplicated_keys", "j15_nearest", "j15_nearest_batch", "h01_health_report", "a38_run_rollup",
    "w08_quantile_amount",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    run()
    samples = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        samples.append(time.perf_counter() - start)
    return round(statistics.median(samples), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("silverbrook-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="silverbrook-bench-")
    seconds: dict[str, float] = {}

    builds = iter(range(1000))
    latest = {}

    def build() -> None:
        latest["path"] = f"{root}/serving-{next(builds)}"
        tables.publish(spark, Frames(spark, SF_DIR).serving, latest["path"])

    seconds["build_serving"] = timed(build)
    serving = tables.read_table(spark, latest["path"])
    for name, mart in ON_SERVING.items():
        seconds[name] = timed(lambda mart=mart: consume(mart(serving)))
    for name in FROM_RAW:
        seconds[name] = timed(lambda name=name: consume(QUERIES[name](spark, SF_DIR)))

    messages = f"{root}/messages"
    nested = bridge.nested_events(spark, SF_DIR)
    events.to_kv(nested, "booking_id").repartition(int(CPUS)).write.parquet(messages)

    def decode() -> None:
        good, _ = events.split_decoded(events.decode_json(spark.read.parquet(messages)))
        consume(events.flatten_booking(good))

    seconds["s02_decode_messages"] = timed(decode)

    rows = serving.agg(F.count(F.lit(1))).first()[0]
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "serving_rows": rows,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
