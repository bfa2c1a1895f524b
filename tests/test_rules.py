"""Boundary values of every business rule, with hand-written answers."""

import pytest
from pyspark.sql import functions as F

from silverbrook.functions import rules

CASES = {
    "email_domain": [("a@b", "b"), ("a", "unknown"), (None, "unknown"), ("a@b@c", "b"), ("@", "")],
    "loyalty_tier": [("gold", "gold"), ("vip", "bronze"), (None, "bronze"), ("platinum", "platinum")],
    "loyalty_rank": [("platinum", 4), ("gold", 3), ("silver", 2), ("bronze", 1), (None, 1), ("x", 1)],
    "pickup_hour": [
        ("12:00 AM", 0), ("12:00 PM", 12), ("1:05 PM", 13), ("11:59 PM", 23), ("5:59 AM", 5), ("6:00 AM", 6),
        ("18:00", 18), ("3:00 pm", 3), ("noon", None), (None, None), ("99999999999:00 PM", None), ("2147483647:0 PM", None),
    ],
    "car_segment": [
        ("Thar", "adventure"), ("Creta", "suv"), ("Nexon", "suv"), ("i20", "hatchback"), ("Baleno", "hatchback"),
        ("Venue", "compact_suv"), ("Swift", "other"), (None, "other"),
    ],
    "payment_method": [
        ("credit card", "credit_card"), ("Credit_Card", "credit_card"), ("debit card", "debit_card"), ("GPay", "upi"),
        ("phonepe", "upi"), ("upi", "upi"), ("COD", "cash"), ("cash", "cash"), ("Net Banking", "net banking"), (None, None),
    ],
    "insurance_coverage": [("full", "full"), ("PARTIAL", "partial"), ("basic", "none"), (None, "none")],
    "insurer_type": [
        ("HDFC", "private_bank"), ("ICICI", "private_bank"), ("TATA AIG", "general_insurance"), ("hdfc", "other"), (None, "other"),
    ],
    "is_digital": [("upi", True), ("credit_card", True), ("cash", False), (None, False)],
    "safe_date": [("2024-01-31", "2024-01-31"), ("", None), ("x", None), ("2024-02-30", None), (None, None)],
    "safe_int": [("12", 12), ("", None), ("x", None), (None, None)],
    "rule_label": [
        ("expect_column_values_to_be_in_set", "in set"), ("expect_column_to_exist", "to exist"),
        ("expect_column_values_to_not_be_null", "values to not be null"),
    ],
}
NUMERIC_CASES = {
    "points_tier": [
        (-1, "bronze_range"), (0, "bronze_range"), (999, "bronze_range"), (1000, "silver_range"), (4999, "silver_range"),
        (5000, "gold_range"), (9999, "gold_range"), (10000, "platinum_range"), (None, "bronze_range"),
    ],
    "price_tier": [(1499.99, "economy"), (1500.0, "standard"), (2999.99, "standard"), (3000.0, "premium"), (None, "economy")],
    "amount_tier": [(4999.99, "low"), (5000.0, "medium"), (9999.99, "medium"), (10000.0, "high"), (None, "low")],
    "pickup_slot": [
        (0, "late_night"), (5, "late_night"), (6, "morning"), (12, "afternoon"), (17, "afternoon"), (18, "evening"),
        (23, "evening"), (None, "evening"), (-1, "evening"),
    ],
    "is_high_value": [(4, True), (3, True), (2, False), (None, False)],
    "fraud_risk_label": [
        (0.0, "LOW"), (25.0, "LOW"), (25.01, "MEDIUM"), (50.0, "MEDIUM"), (75.0, "HIGH"), (100.0, "CRITICAL"),
        (100.1, None), (-0.1, None), (None, None),
    ],
    "churn_risk_label": [
        (0.0, "LOW"), (0.3, "LOW"), (0.6, "MEDIUM"), (0.8, "HIGH"), (1.0, "CRITICAL"), (0.31, "MEDIUM"),
    ],
    "quality_band": [(90.0, "good"), (89.9, "warn"), (70.0, "warn"), (69.9, "critical")],
    "money": [(1.005, 1.01), (2.344, 2.34), (None, None)],
}


def _check(spark, name, cases, ddl):
    cast = (lambda v: v if v is None else float(v)) if ddl == "double" else (lambda v: v)
    df = spark.createDataFrame([(i, cast(c[0])) for i, c in enumerate(cases)], f"i int, x {ddl}")
    got = [r[0] for r in df.select("i", getattr(rules, name)(F.col("x")).alias("y")).orderBy("i").select("y").collect()]
    assert [str(v) if name == "safe_date" and v else v for v in got] == [c[1] for c in cases]


@pytest.mark.parametrize("name", CASES)
def test_text_rule(spark, name):
    _check(spark, name, CASES[name], "string")


@pytest.mark.parametrize("name", NUMERIC_CASES)
def test_numeric_rule(spark, name):
    _check(spark, name, NUMERIC_CASES[name], "double")


def test_trip_and_route(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None)], "p string, d string")
    got = df.select(rules.trip_type(F.col("p"), F.col("d")), rules.route(F.col("p"), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        ("local", "a → a"), ("intercity", "a → b"), ("intercity", None), ("intercity", None),
    ]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(rules.clip(F.col("x"), 0.0, 1.0)).collect()] == [0.0, 0.5, 1.0, None]
