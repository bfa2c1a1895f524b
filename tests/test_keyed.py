"""De-duplication, hot keys, counts and semi joins."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverbrook.operators import keyed

from .conftest import values


def test_newest_wins_and_ties_are_stable(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None), (None, 3, "n")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    for frame in (df, df.repartition(5)):
        got = keyed.newest_per_key(frame, ["k"], ["t"])
        assert got.columns == ["k", "t", "v"]
        assert sorted(values(got, "k", "v"), key=str) == sorted([("a", "z"), ("b", None), (None, "n")], key=str)


def test_newest_of_keys_alone(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert sorted(values(keyed.newest_per_key(df, ["k"], []), "k")) == [("a",), ("b",)]


def _plain_join(left, cars, pays):
    out = Counter()
    for k, name in left:
        for c in [c for key, c in cars if key == k and k is not None] or [None]:
            for p in [p for key, p in pays if key == k and k is not None] or [None]:
                out[(k, name, c, p)] += 1
    return out


@pytest.mark.parametrize("hot_rows", [1, 3, 1000])
def test_split_join_equals_plain_join(spark, hot_rows):
    """One key owns most of both children, with identical copies, and left rows repeat."""
    left = [("hot", "l1"), ("hot", "l2"), ("cars", "l3"), ("pays", "l4"), ("none", "l5"), (None, "l6")]
    cars = [("hot", i % 4) for i in range(20)] + [("cars", 1), ("cars", 1), ("other", 9), (None, 7)]
    pays = [("hot", i) for i in range(7)] + [("pays", 5)]
    frames = [
        spark.createDataFrame(left, "k string, name string"),
        spark.createDataFrame(cars, "k string, c int").repartition(3),
        spark.createDataFrame(pays, "k string, p int").repartition(2),
    ]
    got = keyed.fan_out_left_join(frames[0], frames[1:], "k", hot_rows=hot_rows)
    assert got.columns == ["k", "name", "c", "p"]
    assert Counter(values(got, "k", "name", "c", "p")) == _plain_join(left, cars, pays)
    plain = keyed.fan_out_left_join(frames[0], frames[1:], "k")
    assert Counter(values(plain, "k", "name", "c", "p")) == _plain_join(left, cars, pays)


@pytest.mark.parametrize("hot_rows", [1, 4, 1000])
def test_split_lookup_equals_plain_lookup(spark, hot_rows):
    rows = [("hot", 1)] * 30 + [("hot", i) for i in range(10)] + [("a", 1), ("b", 2), (None, 3)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(4)
    unique = spark.createDataFrame([("hot", "h"), ("a", "x"), ("z", "y")], "k string, v string")
    got = keyed.lookup_left_join(df, unique, ["k"], hot_rows=hot_rows)
    want = keyed.lookup_left_join(df, unique, ["k"])
    assert got.columns == want.columns == ["k", "n", "v"]
    assert Counter(values(got, "k", "n", "v")) == Counter(values(want, "k", "n", "v"))


def largest_share(df):
    """Rows of the fullest partition, and of all."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes), sum(sizes)


@pytest.fixture
def even(spark):
    """Many partitions, as they are: nothing brought together at run time."""
    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_product_is_cut(spark, even):
    """No side is hot by itself; what the key makes is."""
    left = spark.createDataFrame([("hot",)], "k string")
    cars = spark.range(0, 600, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("c"))
    pays = spark.range(0, 500, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("p"))
    most, total = largest_share(keyed.fan_out_left_join(left, [cars, pays], "k", hot_rows=2000))
    assert total == 300_000 and most < total / 10


def test_hot_left_key_and_null_keys_are_cut(spark, even):
    left = spark.range(0, 6000, 1, 8).select(F.when(F.col("id") % 2 == 0, "hot").alias("k"), "id")
    child = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)], "k string, c int")
    most, total = largest_share(keyed.fan_out_left_join(left, [child], "k", hot_rows=100))
    assert total == 9000 and most < total / 8
    unique = spark.createDataFrame([("hot", 1), (None, 2)], "k string, v int")
    found = keyed.lookup_left_join(left, unique, ["k"], hot_rows=100)
    most, total = largest_share(found)
    assert total == 6000 and most < total / 8 and found.filter("v = 1").count() == 3000


def test_duplicated_and_not_in(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None)], "k int, v string")
    assert sorted(values(keyed.duplicated(df, ["k"]), "v")) == [("a",), ("b",)]
    assert values(df.filter(keyed.not_in(F.col("v"), ["a", "b"])), "k") == [(2,)]


def test_latest_run_with_shared_timestamp(spark):
    runs = spark.createDataFrame([("r1", 5), ("r2", 5), ("r0", 1)], "run string, at int")
    records = spark.createDataFrame([("r1", 1), ("r2", 2), ("r2", 3)], "run string, n int")
    assert sorted(values(keyed.latest_run_rows(records, runs, "run", "at"), "n")) == [(2,), (3,)]


def test_counts_are_taken_on_raw_keys(spark):
    cleaned = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    raw = spark.createDataFrame([("a",), ("a",), (" b",)], "k string")
    got = keyed.with_key_count(cleaned, ["k"], "count", counted=raw)
    assert sorted(values(got, "k", "count"), key=str) == [("a", 2), ("a", 2), ("b", None)]


def test_days_since_last(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-05"), ("b", None)], "k string, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    got = keyed.days_since_last(df, "k", "d", F.lit("2024-01-10").cast("date"), 999)
    assert sorted(values(got, "k", "days_since_last_booking")) == [("a", 5), ("a", 5), ("b", 999)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=20))
def test_newest_equals_maximum(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int")
    expected = {k: max(t for key, t in rows if key == k) for k, _ in rows}
    assert dict(values(keyed.newest_per_key(df, ["k"], ["t"]), "k", "t")) == expected
