"""What the plans look like: pruned scans, pushed filters, no Python in SQL-only queries, no global gathers."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from silverbrook.catalog.base import Frames
from silverbrook.plans import marts
from silverbrook.sources import tables

PYTHON_QUERIES = {"s03", "m02", "m03", "m05", "j15_nearest_batch"}


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _reads(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_mart_scans_only_what_it_needs(spark, sf_dir):
    plan = _physical(marts.segments(Frames(spark, sf_dir).mart))
    schemas = " ".join(_reads(plan))
    assert "l_extendedprice" in schemas and "l_tax" not in schemas and "l_shipdate" not in schemas
    assert "o_totalprice" not in schemas and "c_acctbal" not in schemas


def test_filters_reach_the_scan(spark, sf_dir):
    late = Frames(spark, sf_dir).mart.filter(F.col("booking_id") == "B7").select("booking_id", "payment_amount")
    assert "l_tax" not in " ".join(_reads(_physical(late)))
    plan = _physical(tables.read_table(spark, f"{sf_dir}/orders.parquet").filter(F.col("o_custkey") == 7).select("o_orderkey"))
    assert "EqualTo(o_custkey,7)" in plan and "o_totalprice" not in " ".join(_reads(plan))


@pytest.mark.parametrize("name", ["a01_kpi_summary", "a06_top_routes", "a33_share_loyalty_tier", "q12_quarantine", "j04_serving_table"])
def test_no_python_and_no_nested_loops(spark, sf_dir, name):
    plan = _physical(entry.queries()[name](spark, sf_dir))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_top_k_does_not_sort_everything(spark, sf_dir):
    plan = _physical(entry.queries()["a06_top_routes"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_sample_lists_are_cut_before_the_shuffle(spark, sf_dir):
    plan = _physical(entry.queries()["q11_expectation_details"](spark, sf_dir))
    assert "WindowGroupLimit" in plan


def test_entry_points(spark, sf_dir):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # Queries of the optional subpackage for training data have tests of their own.
    weaker = {k for k in set(entry.queries()) - set(entry.oracle_sql()) if not re.match(r"op\d+_|pipeline$", k)}
    assert weaker == {"m02_demand_forecast", "m03_backtest", "m05_anomaly_scores", "m10_churn_scores", "m11_hold_out_auc"}
    assert entry.entry(spark).count() == 10
