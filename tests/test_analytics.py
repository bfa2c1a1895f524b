"""Marts, profiles, series, quantiles, neighbours, quality and health on small frames."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverbrook.operators import frames as fr
from silverbrook.operators import series as sr
from silverbrook.operators import vectors
from silverbrook.operators.quantile import exact_quantile
from silverbrook.plans import health as hl
from silverbrook.plans import marts
from silverbrook.plans import monitoring as mon
from silverbrook.plans import quality as q
from silverbrook.plans.curated import curate

from .conftest import values


# -- marts --------------------------------------------------------------------------------------------------

SERVING = "booking_id string, loyalty_tier string, payment_method string, payment_amount double, price_per_day double"


def _serving(spark):
    rows = [
        ("B1", "gold", "upi", 10.5, 100.0), ("B1", "gold", "upi", 20.5, 100.0), ("B2", "gold", None, None, 200.0),
        (None, "silver", "cash", 5.0, None), ("B3", None, "cash", 7.0, 300.0),
    ]
    return spark.createDataFrame(rows, SERVING)


def test_null_keys_are_kept_by_request_marts_and_dropped_by_explorers(spark):
    df = _serving(spark).withColumn("is_digital_payment", F.col("payment_method") == "upi")
    kept = {r["payment_method"]: r for r in marts.payment_methods(df).collect()}
    assert set(kept) == {"upi", "cash", None}
    assert kept["upi"]["revenue"] == 31.0 and kept["upi"]["digital_count"] == 2 and kept[None]["revenue"] is None
    dropped = {(r[0], r[1]): r[2] for r in marts.tier_by_method(df).collect()}
    assert dropped == {("gold", "upi"): 31.0, ("silver", "cash"): 5.0}
    wide = {r["loyalty_tier"]: r.asDict() for r in marts.tier_by_method(df, pivot_on=["upi", "cash"]).collect()}
    assert wide["gold"]["upi"] == 31.0 and set(wide) == {"gold", "silver"}


def test_filters_and_badge(spark):
    df = _serving(spark)
    assert fr.apply_filters(df, {"loyalty_tier": "gold", "payment_method": None, "absent": 1}).count() == 3
    assert fr.filter_badge(df, {"loyalty_tier": "gold"}).first().asDict() == {"kept": 3, "total": 5, "active": True}


def test_shares_sum_to_100(spark):
    shares = [r["pct"] for r in marts.category_share(_serving(spark), "loyalty_tier").collect()]
    assert math.isclose(sum(shares), 100.0, abs_tol=1e-3) and shares == sorted(shares, reverse=True)


def test_limits_are_checked(spark):
    with pytest.raises(ValueError):
        marts.top_routes(_serving(spark), limit=51)


def test_booking_grain_does_not_repeat_payments(spark):
    booking = spark.createDataFrame([("B1", "C1"), ("B2", "C1")], "booking_id string, customer_id string")
    customer = spark.createDataFrame([("C1", "n")], "customer_id string, customer_name string")
    cars = spark.createDataFrame([("B1", "K1"), ("B1", "K2")], "booking_id string, car_id string")
    payments = spark.createDataFrame([("B1", 10.0), ("B1", 5.5)], "booking_id string, payment_amount double")
    wide = curate(booking, customer, cars, payments)
    assert wide.count() == 5
    fine = curate(booking, customer, cars.limit(1), payments, booking_grain=True)
    assert sorted(values(fine, "booking_id", "payment_amount", "payment_count"), key=str) == [("B1", 15.5, 2), ("B2", None, None)]


# -- distributions ---------------------------------------------------------------------------------------------

def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "x double")
    bins = {r["bin"]: r["n"] for r in fr.histogram(df, "x", 5).collect()}
    assert bins == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}
    constant = fr.histogram(spark.createDataFrame([(7.0,)] * 4, "x double"), "x", 5).collect()
    assert {r["bin"]: r["n"] for r in constant} == {1: 4, 2: 0, 3: 0, 4: 0, 5: 0}
    assert fr.histogram(spark.createDataFrame([], "x double"), "x").count() == 0


def test_profiles(spark):
    df = _serving(spark)
    nulls = {r["column_name"]: (r["null_count"], r["status"]) for r in fr.null_profile(df).collect()}
    assert nulls["booking_id"] == (1, "critical") and nulls["payment_amount"] == (1, "critical")
    exact = {r["column_name"]: tuple(r)[1:] for r in fr.column_profile(df).collect()}
    assert exact["booking_id"] == (1, 20.0, 3) and exact["payment_method"] == (1, 20.0, 2)
    assert {r["column_name"]: tuple(r)[1:] for r in fr.column_profile(df, approx=True).collect()} == exact
    assert fr.duplicate_rate(df, "booking_id").first()["dup_count"] == 2
    assert values(fr.mode_of(df, "payment_method"), "payment_method") == [("cash",)]


# -- series -------------------------------------------------------------------------------------------------------

def _daily(spark, counts, gap=None):
    rows = [(i + (1 if gap is not None and i >= gap else 0), c) for i, c in enumerate(counts)]
    df = spark.createDataFrame(rows, "i int, y long")
    return df.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("ds"), "y")


def test_rolling_band(spark):
    got = sr.rolling_band(_daily(spark, [10] * 7)).orderBy("ds").collect()
    assert all(r["avg7"] == 10 and r["std7"] == 0 and not r["anomaly"] for r in got)
    one = sr.rolling_band(_daily(spark, [5])).first()
    assert (one["avg7"], one["std7"], one["anomaly"]) == (5, 0, False)
    spike = sr.rolling_band(_daily(spark, [10] * 6 + [1000], gap=3)).orderBy("ds").collect()
    assert [r["anomaly"] for r in spike] == [False] * 6 + [True]
    assert spike[-1]["lower"] == 0
    six = sr.rolling_band(_daily(spark, [10] * 4 + [1000])).orderBy("ds").collect()
    assert not any(r["anomaly"] for r in six)


def test_min_max_risk(spark):
    df = spark.createDataFrame([(-0.8,), (-0.5,), (-0.6,)], "s double")
    assert [r[0] for r in sr.min_max_risk(df, "s", "r").orderBy("s").select("r").collect()] == [100.0, 33.33, 0.0]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=40), st.sampled_from([0.0, 0.3, 0.5, 0.77, 1.0]))
def test_exact_quantile_equals_sorting(spark, cents, q_):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    assert exact_quantile(df, "x", q_) == pytest.approx(float(np.quantile(np.array(cents), q_)) / 100, rel=1e-12, abs=1e-9)


def test_exact_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.3) is None


# -- neighbours -------------------------------------------------------------------------------------------------------

def _vectors(spark, n, copies=0, dim=6, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(copies)]
    return rows, spark.createDataFrame(rows, "id long, v array<double>").repartition(4)


def _brute(rows, query, k):
    def cos(a, b):
        return round(float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)), 6)
    return [i for i, _ in sorted(((i, cos(v, query)) for i, v in rows), key=lambda p: (-p[1], p[0]))[:k]]


def test_neighbours_against_brute_force(spark):
    rows, df = _vectors(spark, 60, copies=30)
    assert [r["id"] for r in vectors.nearest(df, rows[0][1], 5, key="id", vector="v").collect()] == _brute(rows, rows[0][1], 5)
    questions = spark.createDataFrame(rows[:7], "qid long, qv array<double>")
    want = {q_: _brute(rows, v, 4) for q_, v in rows[:7]}
    for limit in (100, 3):
        got = vectors.nearest_batch(
            df, questions, 4, key="id", vector="v", query_key="qid", query_vector="qv", query_limit=limit
        )
        found = {}
        for r in got.orderBy("qid", "rank").collect():
            found.setdefault(r["qid"], []).append(r["id"])
        assert found == want


# -- quality ------------------------------------------------------------------------------------------------------------

DQ = "k string, e string, n int"
RULES = [
    {"type": q.ROW_COUNT, "kwargs": {"min_value": 1, "max_value": 3}},
    {"type": q.EXISTS, "kwargs": {"column": "k"}},
    {"type": q.NOT_NULL, "kwargs": {"column": "e"}},
    {"type": q.UNIQUE, "kwargs": {"column": "k"}},
    {"type": q.REGEX, "kwargs": {"column": "e", "regex": q.EMAIL_PATTERN}},
    {"type": q.IN_SET, "kwargs": {"column": "k", "value_set": ["a", "b"]}},
    {"type": q.BETWEEN, "kwargs": {"column": "n", "min_value": 0}},
    {"type": q.BETWEEN, "kwargs": {"column": "n", "max_value": 5}},
    {"type": q.BETWEEN, "kwargs": {"column": "gone", "max_value": 5}},
    {"type": "expect_unheard_of", "kwargs": {"column": "n"}},
]


def _dq_frame(spark):
    return spark.createDataFrame([("a", "x@y.z", 1), ("a", None, -1), ("c", "bad", 9), (None, "q@y.z", None)], DQ)


def test_suite_results(spark):
    checks = q.suite(RULES)
    assert len(checks) == 9
    got = {r["position"]: r for r in q.run_suite(_dq_frame(spark), checks).collect()}
    assert {p: (r["success"], r["missing_count"], r["unexpected_count"]) for p, r in got.items()} == {
        0: (False, 0, 0), 1: (True, 0, 0), 2: (False, 0, 1), 3: (False, 1, 2), 4: (False, 1, 1), 5: (False, 1, 1),
        6: (False, 1, 1), 7: (False, 1, 1), 8: (False, 0, 0),
    }
    summary = q.run_summary(q.run_suite(_dq_frame(spark), checks), "r").first()
    assert (summary["passed_expectations"], summary["failed_expectations"], summary["validation_status"]) == (1, 8, "FAILED")


def test_quarantine_counts_equal_unexpected_counts(spark):
    df, checks = _dq_frame(spark), q.suite(RULES)
    unexpected = {r["position"]: r["unexpected_count"] for r in q.run_suite(df, checks).collect() if r["unexpected_count"]}
    found = {r["position"]: r["count"] for r in q.offending(df, checks).groupBy("position").count().collect()}
    assert found == unexpected
    reasons = {r["position"]: (r["failed_reason"], r["failed_value"]) for r in q.offending(df, checks).collect()}
    assert reasons[2] == ("Null value found", "None")
    assert reasons[5] == ("Value not in set ['a', 'b']", "c") and reasons[6] == ("Value out of range [0 - None]", "-1")


def test_suite_on_empty_table(spark):
    empty = spark.createDataFrame([], DQ)
    got = {r["position"]: r["success"] for r in q.run_suite(empty, q.suite(RULES)).collect()}
    assert got[0] is False and all(got[p] for p in (1, 2, 3, 4, 5, 6, 7))
    assert q.table_failures(q.run_suite(empty, q.suite(RULES)), "r").count() == 1


def test_partial_lists_are_bounded(spark):
    df = spark.range(100).selectExpr("cast(id as string) k", "'x' e", "cast(-id as int) n")
    details = q.expectation_details(df, q.suite(RULES[:8]), "r").collect()
    by_rule = {r["position"]: r for r in details}
    assert by_rule[6]["partial_unexpected_list"].count(",") == q.SAMPLE - 1 and by_rule[6]["min_value"] == "0"
    assert by_rule[3]["partial_unexpected_list"] == "[]"


def test_published_suite_has_27_rules():
    kinds = {}
    for rule in q.booking_suite():
        kinds[rule["type"]] = kinds.get(rule["type"], 0) + 1
    assert sum(kinds.values()) == 27
    assert kinds == {q.ROW_COUNT: 1, q.EXISTS: 2, q.NOT_NULL: 17, q.UNIQUE: 1, q.REGEX: 1, q.IN_SET: 2, q.BETWEEN: 3}


# -- health ----------------------------------------------------------------------------------------------------------------

def _health(spark, failed, failures, warnings, rates, preset):
    now = "timestamp'2024-01-02 00:00:00'"
    stats = spark.createDataFrame([("r", f"s{i}", "FAILED") for i in range(failed)], "run_id string, stage_name string, status string")
    alerts = spark.createDataFrame([("FAILURE",)] * failures + [("DQ_WARNING",)] * warnings, "alert_type string")
    runs = spark.createDataFrame([(f"v{i}", r) for i, r in enumerate(rates)], "run_identifier string, success_rate double")
    return hl.health(
        stats.withColumn("started_at", F.expr(now)), alerts.withColumn("created_at", F.expr(now)),
        runs.withColumn("created_at", F.expr(now)), preset, F.expr(now),
    ).first()


@pytest.mark.parametrize(
    "failed, failures, warnings, rates, preset, score, status",
    [
        (0, 0, 0, [90.0], hl.REPORT, 100, "HEALTHY"),
        (0, 0, 0, [100.0], hl.REPORT, 100, "HEALTHY"),
        (0, 0, 0, [88.0], hl.REPORT, 99, "HEALTHY"),
        (0, 0, 0, [89.0], hl.REPORT, 100, "HEALTHY"),
        (1, 1, 1, [100.0], hl.REPORT, 70, "WARNING"),
        (1, 1, 1, [100.0], hl.SERVICE, 75, "WARNING"),
        (9, 3, 0, [], hl.REPORT, 0, "CRITICAL"),
        (0, 0, 0, [], hl.REPORT, 100, "HEALTHY"),
        (0, 0, 0, [], hl.BOARD, 55, "CRITICAL"),
    ],
)
def test_health(spark, failed, failures, warnings, rates, preset, score, status):
    row = _health(spark, failed, failures, warnings, rates, preset)
    assert (row["health_score"], row["health_status"]) == (score, status)


def test_gate_is_silent_above_the_threshold(spark):
    results = spark.createDataFrame([("r1", 1, 70.0), ("r2", 2, 85.0)], "run_identifier string, created_at int, success_rate double")
    failed = spark.createDataFrame([("email",), ("car_id",), ("email",)], "column_name string")
    assert mon.quality_gate(results, failed).count() == 0
    row = mon.quality_gate(results, failed, threshold=90.0).first()
    assert (row["run_id"], row["failed_cols"]) == ("r2", "car_id, email")


def test_evaluations(spark):
    fraud = spark.createDataFrame([("CRITICAL",), ("HIGH",), ("LOW",), ("LOW",)], "risk_label string")
    assert mon.fraud_evaluation(fraud).first()["verdict"] == "alert"
    assert mon.fraud_evaluation(fraud.filter("risk_label = 'x'")).first()["verdict"] == "normal"
    churn = spark.createDataFrame([(1, 0.9, "LOW"), (2, 0.65, "HIGH")], "created_at int, model_auc double, churn_risk string")
    row = mon.churn_evaluation(churn).first()
    assert (row["auc"], row["verdict"], row["churn_rate_pct"]) == (0.65, "needs_retraining", 50.0)
    days = spark.createDataFrame([("2024-01-01",)] * 10, "d string").select(F.to_date("d").alias("booking_date"))
    forecast = spark.createDataFrame([("2024-01-01", 9.0, None), ("2024-01-02", 9.0, None)], "d string, predicted_bookings double, mape double")
    forecast = forecast.withColumn("forecast_date", F.to_date("d"))
    as_of = F.lit("2024-01-05").cast("date")
    row = mon.forecast_evaluation(days, forecast, as_of=as_of).first()
    assert (row["mape"], row["eval_days"], row["verdict"]) == (10.0, 1, "good")
    stored = forecast.withColumn("mape", F.lit(40.0))
    assert mon.forecast_evaluation(days, stored, as_of=as_of).first()["verdict"] == "needs_retraining"
    late = mon.forecast_evaluation(days, forecast, as_of=F.lit("2025-01-05").cast("date")).first()
    assert (late["status"], late["mape"], late["verdict"]) == ("no_overlap", None, None)


def _odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.9, 0.1]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]),
            (7, [1.0, 0.0, 0.0]), (8, [0.0, 1.0]), (9, [1.0, 0.0])]
    return spark.createDataFrame(rows, "id int, v array<double>")


def test_nearest_leaves_vectors_without_direction_out(spark):
    found = vectors.nearest(_odd_vectors(spark), [1.0, 0.0], 10, key="id", vector="v").collect()
    assert [r.id for r in found] == [1, 9, 3, 8]
    assert vectors.nearest(_odd_vectors(spark), [0.0, 0.0], 10, key="id", vector="v").count() == 0


def test_both_forms_of_batched_search_agree_on_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PAIRS", 2)
    df = _odd_vectors(spark)
    for k in (1, 2, 10):
        small, blocks = (
            sorted(map(tuple, vectors.nearest_batch(df, df.withColumnRenamed("id", "q"), k, key="id", vector="v",
                   query_key="q", query_vector="v", query_limit=n).collect()))
            for n in (100, 2)
        )
        assert small == blocks
        assert len(small) == 4 * min(k, 4) + 1 * 1
