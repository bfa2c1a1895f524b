"""Forecast, anomaly and churn models on frames with a known answer."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from silverbrook.functions import fixed_values as fixed
from silverbrook.plans.scoring import anomaly, churn, features, forecast

from .conftest import values


def _wave(spark, days):
    start = dt.date(2022, 1, 1)
    rows = [
        (start + dt.timedelta(days=i), int(200 + 0.1 * i + 30 * math.sin(2 * math.pi * i / 7)))
        for i in range(days)
    ]
    return rows, spark.createDataFrame(rows, "ds date, y long")


def test_forecast_follows_a_weekly_wave(spark):
    _, daily = _wave(spark, 200)
    got = forecast.forecast(daily, 14).orderBy("forecast_date").collect()
    assert len(got) == 14 and got[0]["forecast_date"] == dt.date(2022, 7, 20)
    for i, row in enumerate(got):
        truth = 200 + 0.1 * (200 + i) + 30 * math.sin(2 * math.pi * (200 + i) / 7)
        assert abs(row["predicted_bookings"] - truth) < 15
        assert 0 <= row["lower_bound"] <= row["predicted_bookings"] <= row["upper_bound"]
    assert 0 < got[0]["mape"] < 10


def test_backtest_folds(spark):
    rows, daily = _wave(spark, 100)
    folds = forecast.backtest(daily).orderBy("cutoff").collect()
    last = rows[-1][0] - dt.timedelta(days=15)
    first = rows[0][0] + dt.timedelta(days=50)
    want = [last - dt.timedelta(days=7 * i) for i in range(20) if last - dt.timedelta(days=7 * i) >= first]
    assert [r["cutoff"] for r in folds] == sorted(want)
    assert all(r["tested"] == 15 for r in folds)
    assert forecast.with_cutoffs(_wave(spark, 59)[1]).count() == 0


def test_category_codes_are_alphabetical(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("c", "x"), (None, "y")], "p string, q string")
    coded = features.with_codes(df, features.fit_codes(df, ["p", "q"]), ["p", "q"])
    assert {r["p"]: r["p_code"] for r in coded.collect()} == {None: 0, "a": 1, "b": 2, "c": 3}
    assert {r["q"]: r["q_code"] for r in coded.collect()} == {None: 0, "x": 1, "y": 2}


def _cloud(spark, n=3000, outliers=30):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (n, 2)))]
    rows += [(n + i, 8.0 + 0.1 * i, -9.0) for i in range(outliers)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df), n


def test_forest_finds_the_outliers_whatever_the_partitioning(spark):
    df, n = _cloud(spark)
    results = []
    for frame in (df, df.repartition(7)):
        nodes = anomaly.fit_forest(frame, ["id"], trees=40, rows=128)
        sizes = nodes.filter("node = 0").agg(F.count("*"), F.min("size"), F.max("size")).first()
        assert tuple(sizes) == (40, 128, 128)
        scored = anomaly.label_scores(anomaly.score_rows(frame, nodes), 0.02)
        results.append({r["id"]: (r["anomaly_score"], r["is_fraud"], r["risk_label"]) for r in scored.collect()})
    assert results[0] == results[1]
    flagged = {i for i, r in results[0].items() if r[1] == 1}
    assert len([i for i in flagged if i >= n]) >= 25
    assert all(-1 <= r[0] < 0 for r in results[0].values())
    assert {r[2] for r in results[0].values()} <= {"LOW", "MEDIUM", "HIGH", "CRITICAL"}


def test_expected_depth():
    got = anomaly._expected_depth(np.array([1, 2, 256]))
    assert got[0] == 0 and got[1] == 1 and got[2] == pytest.approx(10.244770920, abs=1e-3)


def _customers(spark, n=400):
    rows = []
    for i in range(n):
        lost = i % 3 == 0
        day = dt.date(2024, 1, 1) if lost else dt.date(2024, 6, 1) + dt.timedelta(days=i % 20)
        rows.append((f"B{i}", f"C{i}", "K", f"P{i}", day, "gold", 50.0 + i % 7, True, "name", "gold_range", 6 if not lost else 1))
    ddl = ("booking_id string, customer_id string, car_id string, payment_id string, booking_date date, loyalty_tier string, "
           "payment_amount double, is_high_value_customer boolean, customer_name string, points_tier string, booking_month int")
    df = spark.createDataFrame(rows, ddl)
    texts = [c for c in churn.CHURN_CATEGORIES if c not in df.columns]
    return df.withColumns({c: F.lit("x") for c in texts})



def test_churn_model_learns_recency(spark):
    scored = churn.predict_churn(_customers(spark), F.lit("2024-06-30").cast("date"), trees=5, depth=2).collect()
    assert len(scored) == 400 and scored[0]["model_auc"] > 0.95
    risk = {r["customer_id"]: r["churn_probability"] for r in scored}
    assert min(risk[f"C{i}"] for i in range(0, 400, 3)) > max(risk[f"C{i}"] for i in range(1, 400, 3))


def test_split_is_stable_and_disjoint(spark):
    df = _customers(spark).withColumn("churn_label", (F.substring("booking_id", -1, 1) == "7").cast("int"))
    train, test = churn.split(df)
    sizes = {r[0]: r[1] for r in df.groupBy("churn_label").count().collect()}
    assert {r[0]: r[1] for r in test.groupBy("churn_label").count().collect()} == {
        k: int(n * 0.2 + 0.5) for k, n in sizes.items()
    }
    ids = {r[0] for r in values(train, "booking_id")}, {r[0] for r in values(test, "booking_id")}
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 400 and 40 < len(ids[1]) < 120
    again = churn.split(df.repartition(9))[1]
    assert {r[0] for r in values(again, "booking_id")} == ids[1]


@pytest.mark.parametrize("behaviour", [True, False])
def test_single_class_fallbacks(spark, behaviour):
    rows = [(float(i), 1, int(behaviour and i < 4)) for i in range(10)] + [(None, 1, 0)]
    df = spark.createDataFrame(rows, "payment_amount double, churn_label int, behaviour_label int")
    labels = {r["payment_amount"]: r["churn_label"] for r in churn.both_classes(df).collect()}
    assert [labels[float(i)] for i in range(10)] == [int(i < (4 if behaviour else 3)) for i in range(10)]
    assert labels[None] == 0


def test_two_classes_are_left_alone(spark):
    df = spark.createDataFrame([(1.0, 1, 0), (2.0, 0, 0)], "payment_amount double, churn_label int, behaviour_label int")
    assert churn.both_classes(df) is df


def test_roll_up_takes_the_highest_probability(spark):
    rows = [("a", "n", "gold", "t", True, 0.2), ("a", "n", "gold", "t", True, 0.7), (None, "n", "gold", "t", True, 0.9)]
    df = spark.createDataFrame(
        rows, "customer_id string, customer_name string, loyalty_tier string, points_tier string, "
        "is_high_value_customer boolean, churn_probability double")
    got = churn.roll_up(df, 0.8).collect()
    assert [(r["customer_id"], r["churn_probability"], r["churn_risk"]) for r in got] == [("a", 0.7, "HIGH")]


def test_split_numbers_rows_that_tie_at_the_cut(spark):
    rows = [("b", "c", "p", 1)] * 10 + [(f"b{i}", "c", "p", 0) for i in range(9)]
    df = spark.createDataFrame(rows, "booking_id string, car_id string, payment_id string, churn_label int")
    train, test = churn.split(df)
    assert {r[0]: r[1] for r in test.groupBy("churn_label").count().collect()} == {0: 2, 1: 2}
    assert train.count() == 15


def test_trees_draw_from_the_whole_table_and_small_tables_whole(spark):
    big = spark.range(20_000).select(F.col("id").alias("k"), F.array(F.col("id").cast("double")).alias("x"))
    drawn = anomaly.tree_samples(big, ["k"], 20, 100)
    sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert len(sizes) == 20 and 60 < min(sizes) and max(sizes) < 220
    assert drawn.groupBy("tree", "k").count().filter("count > 1").count() == 0
    small = anomaly.tree_samples(big.limit(30), ["k"], 20, 100).groupBy("tree").count().collect()
    assert {r["count"] for r in small} == {30} and len(small) == 20


def test_labels_count_rows_without_customer_and_take_a_subquery_as_day(spark):
    rows = [("c1", "2024-01-01", 10.0), ("c1", "2024-03-01", 30.0), ("c2", "2023-01-01", None), (None, "2024-03-01", 2.0)]
    made = [(*r, "gold", True) for r in rows]
    df = spark.createDataFrame(
        made, "customer_id string, booking_date string, payment_amount double, loyalty_tier string, is_high_value_customer boolean"
    ).withColumn("booking_date", F.col("booking_date").cast("date"))
    got = churn.label_churn(df, df.agg(F.max("booking_date")).scalar())
    labels = {(r.customer_id, r.days_since_last_booking, r.churn_label) for r in got.collect()}
    # Days are 0, 0, 425 and, for a row without customer, the fixed number: the quantile is below the fixed floor.
    assert labels == {("c1", 0, 0), ("c2", 425, 1), (None, fixed.UNSEEN_DAYS, 1)}
    assert got.count() == 4 and churn.label_churn(df.limit(0), F.current_date()).count() == 0


def test_leaves_lead_to_themselves_and_paths_are_those_of_the_nodes():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(200, 3)), 1)
    nodes = pd.concat([anomaly._grow(x[:50], t, np.random.default_rng(t)) for t in range(3)])
    forest = anomaly.Forest(nodes)
    lengths = np.zeros(len(x))
    for t, tree in nodes.groupby("tree"):
        tree = tree.set_index("node")
        for i, row in enumerate(x):
            at = tree.loc[0]
            while at["feature"] >= 0:
                at = tree.loc[at["left"] if row[int(at["feature"])] <= at["threshold"] else at["right"]]
            lengths[i] += at["depth"] + anomaly._expected_depth(np.array([at["size"]]))[0]
            leaf = t * forest.width + int(at.name)
            assert forest.next[2 * leaf] == forest.next[2 * leaf + 1] == leaf
    assert np.allclose(forest.score(x), -np.exp2(-lengths / 3 / forest.norm))
