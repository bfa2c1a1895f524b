"""How often a frame is worked out, read from plans, and results that must not depend on it."""

from pyspark.sql import functions as F

from silverbrook.llm.packing import least_slack
from silverbrook.operators import keyed
from silverbrook.plans import quality as q
from silverbrook.plans.scoring import churn

RULES = [
    {"type": q.UNIQUE, "kwargs": {"column": "k"}},
    {"type": q.UNIQUE, "kwargs": {"column": "n"}},
    {"type": q.NOT_NULL, "kwargs": {"column": "e"}},
    {"type": q.BETWEEN, "kwargs": {"column": "n", "min_value": 0}},
]


def _scans(df, column):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [" in line and f"{column}#" in line for line in plan.splitlines())


def _written(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/rows")
    return spark.read.parquet(f"{folder}/rows")


def test_offending_rows_read_the_frame_once(spark, folder):
    rows = [("a", None, 1), ("a", "x", -1), ("b", "x", 2), (None, "x", 3), (None, None, 2)]
    df = _written(spark, rows, "k string, e string, n int", folder)
    found = q.offending(df, q.suite(RULES))
    assert _scans(found, "e") == 1
    got = sorted((r["position"], r["failed_reason"], r["failed_value"], r["n"]) for r in found.collect())
    twice, empty, low = "Duplicate value found", "Null value found", "Value out of range [0 - None]"
    assert got == [
        (0, twice, "a", -1), (0, twice, "a", 1), (1, twice, "2", 2), (1, twice, "2", 2),
        (2, empty, "None", 1), (2, empty, "None", 2), (3, low, "-1", -1),
    ]


def test_details_share_the_counts_of_unique_values(spark, folder):
    rows = [("a", "x", 1), ("a", "x", 2), ("b", "x", 3), (None, "x", 4), (None, "x", 5)]
    df = _written(spark, rows, "k string, e string, n int", folder)
    found = q.expectation_details(df, q.suite(RULES), "r")
    # One pass for the conditions of rows and one for their values; the counts are read back.
    assert _scans(found, "e") == 2
    first = {r["position"]: r for r in found.collect()}[0]
    assert (first["unexpected_count"], first["missing_count"]) == (2, 2)
    assert first["partial_unexpected_counts"] == '[{"value":"a","count":2}]'


def test_each_part_of_a_split_is_one_filter(spark, folder):
    labels = [(f"b{i}", "c", "p", None if i % 7 == 0 else i % 3) for i in range(1000)]
    df = _written(spark, labels, "booking_id string, car_id string, payment_id string, churn_label int", folder)
    train, test = churn.split(df)
    assert _scans(train, "booking_id") == _scans(test, "booking_id") == 1
    sizes = {r[0]: r[1] for r in df.groupBy("churn_label").count().collect()}
    held = {r[0]: r[1] for r in test.groupBy("churn_label").count().collect()}
    assert held == {k: int(n * 0.2 + 0.5) for k, n in sizes.items()} and None in held
    assert train.unionByName(test).exceptAll(df).isEmpty() and train.count() + test.count() == 1000
    cut = test.agg(F.max(F.xxhash64(*churn.KEYS, F.lit(churn.SEED)))).first()[0]
    assert cut < 0  # the smallest hashes of a class, by their signed value


def test_hot_keys_are_cut_into_no_more_cells_than_they_need(spark):
    sides = [spark.createDataFrame([(k,) * n for k, rows in size.items() for n in [1] * rows], "k string") for size in (
        {"one": 1, "left": 50, "both": 3}, {"one": 7, "left": 1, "both": 6}, {"one": 7, "both": 1})]
    cut = {r["k"]: [r[f"_slices{i}"] for i in range(3)] for r in keyed._hot_slices(sides, "k", 9).collect()}
    assert cut["one"][0] == 1 and sorted(cut["one"][1:]) == [2, 3]  # 49 rows in six cells, not in sixteen
    assert cut["left"] == [6, 1, 1]  # the one large side takes the whole cut
    assert cut["both"] == [1, 2, 1]
    sides = [s.withColumn(f"v{i}", F.monotonically_increasing_id()) for i, s in enumerate(sides)]
    joined = keyed.fan_out_left_join(sides[0], sides[1:], "k", 9)
    plain = sides[0].join(sides[1], "k", "left").join(sides[2], "k", "left")
    assert joined.count() == plain.count() == joined.distinct().count()
    assert joined.exceptAll(plain.select(*joined.columns)).isEmpty()


def test_features_are_written_before_they_are_fitted(spark, sf_dir):
    from silverbrook.catalog.base import Frames

    featured = churn.training_frame(Frames(spark, sf_dir).serving, F.lit("2001-09-01").cast("date"))
    assert "Join" not in featured._jdf.queryExecution().optimizedPlan().toString()
    assert {"features", "churn_label", "customer_id", *churn.KEYS, *churn.ATTRIBUTES} <= set(featured.columns)


def test_least_slack_takes_sorted_lengths():
    counts = {5: 2, 3: 0, 7: 1, 4: 3}
    assert least_slack(counts, 16, [7, 5, 4]) == least_slack(counts, 16) == {7: 1, 5: 1, 4: 1}
