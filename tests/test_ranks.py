"""Prefix sums, exact AUC, codes, shared uniqueness counts, sketches, hyperplanes and models from moments."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from silverbrook.catalog.base import Frames
from silverbrook.operators import hyperplanes, ranks, vectors
from silverbrook.plans import marts, quality, sketches
from silverbrook.plans.curated import curate
from silverbrook.plans.scoring import features, forecast, grams

from .conftest import values


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefix_sums_over_many_partitions(spark):
    rows = [(i * 7 % 1000, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, n long").repartition(6)
    got = {r["k"]: r["before_n"] for r in ranks.with_prefix_sums(df, ["k"], ["n"]).collect()}
    total = 0
    for k, n in sorted(rows):
        assert got[k] == total
        total += n


def brute_auc(rows):
    won = [(p > q) + (p == q) / 2 for p, a in rows if a == 1 for q, b in rows if b == 0]
    return sum(won) / len(won)


def test_auc_is_exact_with_ties_and_many_scores(spark):
    draw = random.Random(4)
    rows = [(draw.choice([draw.random(), 0.25, 0.5]), draw.randint(0, 1)) for _ in range(3000)]
    df = spark.createDataFrame([*rows, (None, 1), (0.3, None)], "p double, y int").repartition(5)
    found = ranks.area_under_curve(df, "p", "y").first()
    assert found.tested == 3000 and found.auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert ranks.area_under_curve(df.filter("y = 1"), "p", "y").first().auc is None
    assert tuple(ranks.area_under_curve(df.limit(0), "p", "y").first()) == (0, None)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_codes_by_broadcast_and_by_join(spark, monkeypatch, bound):
    monkeypatch.setattr(ranks, "BROADCAST_CODES", bound)
    df = spark.createDataFrame([(i, f"v{i % 37:02d}" if i % 5 else None, "x") for i in range(400)], "id int, a string, b string")
    coded = features.with_codes(df, features.fit_codes(df.filter("id < 395"), ["a", "b"]), ["a", "b"])
    names = sorted({f"v{i % 37:02d}" if i % 5 else "None" for i in range(395)})
    assert {(r.id, r.a_code, r.b_code) for r in coded.collect()} == {
        (i, names.index(f"v{i % 37:02d}" if i % 5 else "None"), 0) for i in range(400)
    }
    assert coded.columns == ["id", "a", "b", "a_code", "b_code"]
    unseen = features.with_codes(df.withColumn("b", F.lit("new")), features.fit_codes(df, ["b"]), ["b"])
    assert {r.b_code for r in unseen.collect()} == {1}


@pytest.mark.parametrize("hot_rows", [2_000_000, 3])
def test_curated_codes_equal_the_codes_of_the_curated_table(spark, hot_rows):
    """Repeated and missing keys, bookings without cars, payments or customers, cars of no booking, null values."""
    ids = ["b1", "b1", "b2", "b3", "b4", None]
    booking = spark.createDataFrame([(b, f"c{i % 3}" if i else None, f"t{i % 2}") for i, b in enumerate(ids)],
                                    "booking_id string, customer_id string, trip_type string")
    customer = spark.createDataFrame([("c0", "gold"), ("c1", None)], "customer_id string, loyalty_tier string")
    cars = spark.createDataFrame(
        [("b1", "k1", "Zen"), ("b1", "k2", None), ("b2", "k3", "Aa"), ("b2", "k3", "Aa"), ("x", "k4", "Mm"), (None, "k5", "Nn")],
        "booking_id string, car_id string, model string",
    )
    payments = spark.createDataFrame(
        [("b1", "p1", "upi"), ("b1", "p2", "cash"), ("b3", "p3", "Card"), ("b2", "p4", "upi"), ("b4", "p5", "upi"), ("y", "p6", "zz")],
        "booking_id string, payment_id string, payment_method string",
    )
    names, keys = ["loyalty_tier", "payment_method", "model", "trip_type"], ["booking_id", "car_id", "payment_id"]

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    for paid in (payments, payments.limit(0), payments.unionAll(booking.selectExpr("booking_id", "'p7'", "'upi'"))):
        whole = curate(booking, customer, cars, paid)
        expected = features.with_codes(whole, features.fit_codes(whole, names), names)
        found = features.curated_codes(booking, customer, cars, paid, names, keys, hot_rows)
        assert rows(found) == rows(expected.select(*keys, *[f"{n}_code" for n in names]))


def test_catalog_codes_meet_no_value_after_the_bookings_fan_out(spark, sf_dir):
    plan = _physical(entry.queries()["m04_category_codes"](spark, sf_dir))
    texts = [line for line in plan.splitlines() if "Join" in line and "_value" in line]
    # Each side's values are looked up before the two joins by booking, not in their result.
    order = [line for line in plan.splitlines() if "Join" in line]
    assert len(texts) == len(features.CATEGORIES) and "booking_id" in order[0] and "booking_id" in order[1]


def test_codes_of_the_catalog_come_without_a_gather(spark, sf_dir):
    plan = _physical(entry.queries()["m04_category_codes"](spark, sf_dir))
    assert "StringIndexer" not in plan and "SinglePartition" not in plan and "Python" not in plan


def test_all_uniqueness_rules_share_one_exchange(spark):
    rows = [(i, i % 10, None if i % 3 else "x", "same") for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, c string, d string")
    found = quality.duplicate_rows(df, ["a", "b", "c", "d"])
    assert dict(values(found, "column_name", "n")) == {"a": 0, "b": 300, "c": 100, "d": 300}
    # One exchange by value, one by rule over its few partial sums.
    assert _physical(found).count("Exchange hashpartitioning") == 2
    many = quality.run_suite(df, quality.suite([{"type": quality.UNIQUE, "kwargs": {"column": c}} for c in "abcd"]))
    assert {r.column_name: r.unexpected_count for r in many.collect()} == {"a": 0, "b": 300, "c": 100, "d": 300}
    empty = quality.run_suite(df.limit(0), quality.suite([{"type": quality.UNIQUE, "kwargs": {"column": "a"}}]))
    assert [(r.success, r.unexpected_count) for r in empty.collect()] == [(True, 0)]


def test_sketches_answer_windows_without_the_serving_table(spark, sf_dir, folder):
    mart = Frames(spark, sf_dir).mart.cache()
    path = f"{folder}/sketches"
    sketches.store(sketches.daily_sketches(mart), path)
    stored = sketches.window(spark, path)
    exact, found = marts.kpi_summary(mart).first(), sketches.kpi_summary(stored).first()
    for name in ("total_bookings", "total_revenue", "high_value_customers", "digital_payments"):
        assert found[name] == exact[name]
    for name in ("total_customers", "unique_routes", "car_segments", "car_models"):
        assert abs(found[name] - exact[name]) <= 0.03 * exact[name]
    plan = _physical(sketches.kpi_summary(stored))
    assert plan.count("FileScan") == 1 and "sketches" in plan and "lineitem" not in plan
    last = mart.agg(F.max("booking_date")).first()[0]
    recent = sketches.kpi_summary(sketches.window(spark, path, 90, F.lit(last))).first()
    want = marts.kpi_summary(mart.filter(F.col("booking_date") >= F.date_sub(F.lit(last), 90))).first()
    assert recent.total_bookings == want.total_bookings and recent.total_revenue == want.total_revenue
    # A refresh of one month replaces that month alone.
    month = mart.filter(F.date_format("booking_date", "yyyy-MM") == last.strftime("%Y-%m"))
    sketches.store(sketches.daily_sketches(month), path)
    assert sketches.kpi_summary(sketches.window(spark, path)).first() == found
    mart.unpersist()


def test_sketches_of_empty_and_null_rows(spark, folder):
    kinds = "booking_date date, loyalty_tier string, payment_amount double, is_high_value_customer boolean, is_digital_payment boolean, loyalty_points int, customer_id string, route string, car_segment string, model string"
    df = spark.createDataFrame([(None,) * 10, (dt.date(2024, 1, 1), "gold", 5.0, True, None, 3, "c", None, None, "m")], kinds)
    sketches.store(sketches.daily_sketches(df), f"{folder}/s")
    got = sketches.kpi_summary(sketches.window(spark, f"{folder}/s")).first()
    assert (got.total_bookings, got.total_customers, got.unique_routes, got.car_models) == (2, 1, 0, 1)
    tiers = {r.loyalty_tier: (r.bookings, r.customers, r.avg_points) for r in sketches.loyalty_value(sketches.window(spark, f"{folder}/s")).collect()}
    assert tiers == {None: (1, 0, None), "gold": (1, 1, 3.0)}


@given(st.integers(0, 2**31), st.integers(2, 7))
@settings(max_examples=30, deadline=None)
def test_probes_are_distinct_and_begin_with_the_own_bucket(seed, bits):
    draw = np.random.default_rng(seed)
    x, normals = draw.standard_normal((3, 9)), hyperplanes.hyperplanes(9, 2, bits, seed)
    found = hyperplanes.buckets_of(x, normals, 5)
    own = hyperplanes.buckets_of(x, normals)
    assert (found[:, :, :1] == own).all()
    assert all(len(set(b)) == len(b) for rows in found for b in rows)
    assert found.max() < 2**bits and found.min() >= 0


def test_hyperplanes_find_neighbours_with_exact_scores(spark):
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((40, 16))
    rows = [(i, (centres[i % 40] + 0.3 * draw.standard_normal(16)).tolist()) for i in range(1600)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [1.0] * 3), (5003, [float("nan")] * 16)] + [(6000 + i, rows[0][1]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    asked = df.filter("id % 50 = 0 or id in (5001, 5002)").select(F.col("id").alias("q"), F.col("v").alias("w"))
    names = dict(key="id", vector="v", query_key="q", query_vector="w")
    found = hyperplanes.nearest_approximate(df, asked, 5, tables=8, bits=5, probes=6, **names).cache()
    exact = vectors.nearest_batch(df, asked, 5, **names)
    assert hyperplanes.recall(found, exact, "q", "id").first().recall >= 0.9
    truth = {(r.q, r.id): r.similarity for r in vectors.nearest_batch(df, asked, 2000, **names).collect()}
    assert all(truth[r.q, r.id] == pytest.approx(r.similarity, abs=2e-6) for r in found.collect())
    assert {r.q for r in found.filter("rank = 1").collect()} == {r.q for r in asked.filter("q not in (5000, 5001)").collect()}
    # Work a question makes is far below the table.
    assert hyperplanes.expected_candidates(1600, 8, 5, 6) < 1600 * 8 * 6 / 16
    assert hyperplanes.nearest_approximate(df.limit(0), asked, 5, **names).count() == 0


def _refit(daily, terms, ridge, period=7, horizon=15):
    """Errors by refitting every fold on its own rows."""
    daily = sorted(daily)
    n, last = len(daily), daily[-1][0] - dt.timedelta(days=horizon)
    first = daily[0][0] + dt.timedelta(days=max(30, n // 2))
    out = {}
    while last >= first:
        past = [(d, y) for d, y in daily if d <= last]
        tested = [(d, y) for d, y in daily if last < d <= last + dt.timedelta(days=horizon) and y > 0]
        x, y = terms([d for d, _ in past]), np.array([v for _, v in past], dtype=float)
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 0, scale, 1.0)
        z = (x - mean) / scale
        beta = np.linalg.solve(z.T @ z + ridge * len(y) * np.eye(z.shape[1]), z.T @ (y - y.mean()))
        guess = np.maximum((terms([d for d, _ in tested]) - mean) / scale @ beta + y.mean(), 0.0)
        truth = np.array([v for _, v in tested], dtype=float)
        out[last] = (len(tested), float((np.abs(guess - truth) / truth).mean() * 100))
        last -= dt.timedelta(days=period)
    return out


@pytest.mark.parametrize(("terms", "ridge"), [(grams.seasonal_terms, 1e-3), (grams.weekday_terms, 0.0)])
def test_backtest_from_running_sums_equals_refits(spark, terms, ridge):
    draw, start = random.Random(2), dt.date(2022, 1, 1)
    rows = [(start + dt.timedelta(days=i), draw.randint(0, 60) + i // 3) for i in range(500) if i % 17]
    daily = spark.createDataFrame(rows, "ds date, y long").repartition(4)
    got = {r.cutoff: (r.tested, r.mape) for r in grams.backtest(daily, terms=terms, ridge=ridge).collect()}
    want = _refit(rows, terms, ridge)
    assert got.keys() == want.keys()
    for cutoff, (tested, mape) in want.items():
        assert got[cutoff][0] == tested and got[cutoff][1] == pytest.approx(mape, abs=1e-6)


def test_no_day_is_copied_to_the_folds_that_train_on_it(spark):
    start = dt.date(2022, 1, 1)
    daily = spark.createDataFrame([(start + dt.timedelta(days=i), 5 + i % 7) for i in range(300)], "ds date, y long")
    copies = forecast.with_cutoffs(daily).count()
    tested = forecast.cutoffs(daily).count() * 15
    assert copies > 3 * 300 and tested <= 3 * 300
    assert grams.backtest(daily.limit(0)).count() == 0 and grams.backtest(daily.limit(40)).count() == 0


def test_series_have_models_of_their_own_or_the_pooled_shape(spark):
    start, rows = dt.date(2022, 1, 3), []
    for i in range(200):
        day = start + dt.timedelta(days=i)
        rows.append(("a", day, 100 + 2 * i + 10 * (i % 7)))
        rows.append((None, day, 50))
        if i >= 170:
            rows.append(("short", day, 7))
    daily = spark.createDataFrame(rows, "s string, ds date, y long").repartition(5)
    found = grams.series_forecast(daily, ["s"], terms=grams.weekday_terms, ridge=0.0).collect()
    by = {}
    for r in sorted(found, key=lambda r: r.forecast_date):
        assert 0 <= r.lower_bound <= r.predicted_bookings <= r.upper_bound
        by.setdefault(r.s, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"a": 30, None: 30, "short": 30}
    assert [r.pooled for r in (by["a"][0], by[None][0], by["short"][0])] == [False, False, True]
    for k, r in enumerate(by["a"]):
        i = 200 + k
        assert r.forecast_date == start + dt.timedelta(days=i)
        assert r.predicted_bookings == pytest.approx(100 + 2 * i + 10 * (i % 7), abs=1e-6)
    assert all(r.predicted_bookings == pytest.approx(50, abs=1e-9) for r in by[None])
    assert np.mean([r.predicted_bookings for r in by["short"]]) > 0
    assert grams.series_forecast(daily.limit(0), ["s"]).count() == 0


def test_models_of_constant_and_dependent_features():
    x = np.column_stack([np.ones(10), np.ones(10), np.arange(10.0), 2 * np.arange(10.0)])
    y = 3 * np.arange(10.0) + 1
    rows = np.column_stack([x, y])
    flat = (rows.T @ rows)[np.triu_indices(5)]
    model = grams.Model(flat, 0.0)
    assert np.allclose(model.predict(x[:, 1:]), y) and model.rmse < 1e-6
    assert math.isclose(model.level, y.mean())


def test_buckets_cut_into_blocks_find_the_same(spark, monkeypatch):
    draw = np.random.default_rng(2)
    rows = [(i, draw.standard_normal(8).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows + [(1000 + i, rows[0][1]) for i in range(60)], "id int, v array<float>")
    asked = df.filter("id % 20 = 0").select(F.col("id").alias("q"), F.col("v").alias("w"))
    names = dict(key="id", vector="v", query_key="q", query_vector="w")
    whole = hyperplanes.nearest_approximate(df, asked, 4, tables=4, bits=2, probes=2, **names)
    assert "FlatMapCoGroupsInPandas" in whole._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(hyperplanes, "BLOCK_ROWS", 20)
    monkeypatch.setattr(hyperplanes, "QUERY_LIMIT", 3)
    cut = hyperplanes.nearest_approximate(df, asked, 4, tables=4, bits=2, probes=2, **names)
    assert len(want) == 4 * asked.count() and sorted(map(tuple, cut.collect())) == want
