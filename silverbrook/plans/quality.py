"""Declarative data-quality suite: one aggregate for all row rules, one pass for the quarantine (Q01-Q12).

A rule is ``{"type": ..., "kwargs": {...}}``. Row rules become "unexpected" conditions that ignore nulls
(except not-null itself); uniqueness adds one aggregate per checked column; table rules look at the
schema or the row count.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import FAILED_RECORD_COLUMNS
from ..functions import rules as shapes
from ..functions.measures import rows
from ..operators.keyed import key_counts, lookup_left_join, not_in
from ..sources.tables import staged

log = logging.getLogger(__name__)

# Rule names of the published suite.
ROW_COUNT = "expect_table_row_count_to_be_between"
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
GREATER = "expect_column_values_to_be_greater_than"
LESS = "expect_column_values_to_be_less_than"
KNOWN = {ROW_COUNT, EXISTS, NOT_NULL, UNIQUE, REGEX, IN_SET, BETWEEN, GREATER, LESS}
TABLE_LEVEL = "table_level"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
MAX_ROWS = 1_000_000
SAMPLE = 20


@dataclass(frozen=True)
class Rule:
    """One expectation of a suite."""

    position: int
    type: str
    kwargs: dict

    @property
    def column(self) -> str:
        return self.kwargs.get("column", TABLE_LEVEL)

    @property
    def by_row(self) -> bool:
        return self.type not in (ROW_COUNT, EXISTS)

    @property
    def reason(self) -> str:
        low, high = self.kwargs.get("min_value"), self.kwargs.get("max_value")
        return {
            UNIQUE: "Duplicate value found",
            NOT_NULL: "Null value found",
            IN_SET: f"Value not in set {self.kwargs.get('value_set', [])}",
            REGEX: f"Regex mismatch: {self.kwargs.get('regex', '')}",
        }.get(self.type, f"Value out of range [{low} - {high}]")

    def unexpected(self) -> Column:
        """Condition of an offending row; null or false otherwise. Uniqueness reads its joined mark."""
        value = F.col(self.column)
        if self.type == NOT_NULL:
            return value.isNull()
        if self.type == UNIQUE:
            return F.col(_mark(self.column))
        if self.type == IN_SET:
            return not_in(value, self.kwargs["value_set"])
        if self.type == REGEX:
            return ~value.rlike(self.kwargs["regex"])
        if self.type in (GREATER, LESS):
            value = value.try_cast("double")
        low, high = self.kwargs.get("min_value"), self.kwargs.get("max_value")
        outside = F.lit(False)
        if low is not None:
            outside = outside | (value < low)
        if high is not None:
            outside = outside | (value > high)
        return outside


def _mark(column: str) -> str:
    return f"_dup_{column}"


def suite(spec: Sequence[dict]) -> list[Rule]:
    """Rules of a suite; a type that is not known is skipped with a warning (Q08)."""
    found = []
    for entry in spec:
        if entry["type"] in KNOWN:
            found.append(Rule(len(found), entry["type"], dict(entry["kwargs"])))
        else:
            log.warning("skipping unknown rule type %s", entry["type"])
    return found


def load_suite(path: str) -> list[Rule]:
    return suite(json.loads(Path(path).read_text())["expectations"])


def booking_suite() -> list[dict]:
    """The published serving-table suite: 27 rules in 7 types, column by column in table order."""
    # Required columns with the further rules on them.
    further = {
        "booking_id": [(UNIQUE, {})],
        "email": [(REGEX, {"regex": EMAIL_PATTERN})],
        "loyalty_tier": [(IN_SET, {"value_set": ["platinum", "gold", "silver", "bronze"]})],
        "loyalty_points": [(BETWEEN, {"min_value": 0})],
        "price_per_day": [(BETWEEN, {"min_value": 0})],
        "insurance_coverage": [(IN_SET, {"value_set": ["full", "partial"]})],
        "payment_amount": [(BETWEEN, {"min_value": 0})],
    }
    spec = [
        {"type": ROW_COUNT, "kwargs": {"min_value": 1, "max_value": MAX_ROWS}},
        {"type": EXISTS, "kwargs": {"column": "booking_id"}},
        {"type": EXISTS, "kwargs": {"column": "customer_id"}},
    ]
    for column in FAILED_RECORD_COLUMNS:
        spec.append({"type": NOT_NULL, "kwargs": {"column": column}})
        spec += [{"type": t, "kwargs": {"column": column, **k}} for t, k in further.get(column, [])]
    return spec


# -- evaluation ---------------------------------------------------------------------------------------------

def run_suite(df: DataFrame, checks: Sequence[Rule], counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Success and counts per rule (Q01-Q07, Q09).

    All row rules share one aggregate over the frame. All uniqueness rules share another: their values are counted
    together, in one exchange, and what they find is attached as scalar subqueries of one row. Columns that ``counted``,
    the frame's ``repeats``, has counted already are not counted again, but for fractions, of which text tells more apart.
    """
    usable = [c for c in checks if c.type == EXISTS or c.column == TABLE_LEVEL or c.column in df.columns]
    gone = [c for c in checks if c not in usable]
    row_rules = [c for c in usable if c.by_row and c.type != UNIQUE]
    nullable = sorted({c.column for c in usable if c.by_row and c.type != NOT_NULL})
    measured = df.agg(
        rows().alias("n"),
        *[F.count_if(c.unexpected()).alias(f"u{c.position}") for c in row_rules],
        *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in nullable],
    )
    unique = list(dict.fromkeys(c.column for c in usable if c.type == UNIQUE))
    if unique:
        known = [c for c in unique if c in (counted or {}) and dict(df.dtypes)[c] not in ("float", "double")]
        fresh = [c for c in unique if c not in known]
        parts = [_repeated_rows(counted[c], c) for c in known] + ([duplicate_rows(df, fresh)] if fresh else [])
        repeated = reduce(DataFrame.unionByName, parts)
        found = repeated.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "n")))).scalar()
        measured = measured.withColumn("_repeated", found)
    for c in usable:
        if c.type == UNIQUE:
            measured = measured.withColumn(f"u{c.position}", F.coalesce(F.col("_repeated")[c.column], F.lit(0)))
    outcome = F.array(*[_outcome(c, df.columns) for c in usable], *[_failed_outright(c) for c in gone])
    counted = measured.select(F.explode(outcome).alias("r")).select("r.*")
    present = F.col("element_count") - F.col("missing_count")
    return counted.select(
        "position",
        "expectation_type",
        "column_name",
        "success",
        "observed_value",
        "element_count",
        "missing_count",
        _pct(F.col("missing_count"), F.col("element_count")).alias("missing_percent"),
        "unexpected_count",
        _pct(F.col("unexpected_count"), present).alias("unexpected_percent"),
        _pct(F.col("unexpected_count"), F.col("element_count")).alias("unexpected_percent_total"),
        _pct(F.col("unexpected_count"), present).alias("unexpected_percent_nonmissing"),
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n`` for each column: how many rows share their non-null value with another row.

    Each row becomes one cell a column, cells are combined map-side and meet in a single exchange, whatever the number
    of columns. A value is counted by its 128-bit digest, so long values cost no more than short ones, and a value that
    much of the table shares is one row a task before it is shuffled.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    digest = F.unhex(F.md5(F.col("cell.value").cast("binary")))
    counted = (
        df.select(F.explode(cells).alias("cell"))
        .filter(F.col("cell.value").isNotNull())
        .groupBy(F.col("cell.at").alias("at"), digest.alias("value"))
        .agg(rows().alias("n_rows"))
    )
    repeated = counted.groupBy("at").agg(F.coalesce(F.sum(F.when(F.col("n_rows") > 1, F.col("n_rows"))), F.lit(0)).alias("n"))
    return repeated.select(F.array(*[F.lit(c) for c in columns])[F.col("at")].alias("column_name"), "n")


def _repeated_rows(counts: DataFrame, column: str) -> DataFrame:
    """``column_name, n`` as of ``duplicate_rows``, from the rows of each value."""
    shared = F.when(F.col(column).isNotNull() & (F.col("_rows") > 1), F.col("_rows"))
    return counts.agg(F.lit(column).alias("column_name"), F.coalesce(F.sum(shared), F.lit(0)).alias("n"))


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100 / whole, 4)).otherwise(0.0)


def _result(c: Rule, success: Column, observed: Column, n: Column, missing: Column, unexpected: Column) -> Column:
    return F.struct(
        F.lit(c.position).alias("position"),
        F.lit(c.type).alias("expectation_type"),
        F.lit(c.column).alias("column_name"),
        success.alias("success"),
        observed.cast("string").alias("observed_value"),
        n.cast("long").alias("element_count"),
        missing.cast("long").alias("missing_count"),
        unexpected.cast("long").alias("unexpected_count"),
    )


def _outcome(c: Rule, columns: Sequence[str]) -> Column:
    zero, none = F.lit(0), F.lit(None)
    if c.type == ROW_COUNT:
        low, high = c.kwargs.get("min_value"), c.kwargs.get("max_value")
        fits = F.lit(True)
        fits = fits if low is None else fits & (F.col("n") >= low)
        fits = fits if high is None else fits & (F.col("n") <= high)
        return _result(c, fits, F.col("n"), zero, zero, zero)
    if c.type == EXISTS:
        return _result(c, F.lit(c.column in columns), none, zero, zero, zero)
    missing = zero if c.type == NOT_NULL else F.col(f"m_{c.column}")
    unexpected = F.col(f"u{c.position}")
    return _result(c, unexpected == 0, none, F.col("n"), missing, unexpected)


def _failed_outright(c: Rule) -> Column:
    """A rule on a column the frame lacks fails; it must not abort the other rules."""
    return _result(c, F.lit(False), F.lit(None), F.lit(0), F.lit(0), F.lit(0))


def run_summary(results: DataFrame, run_id: str, checkpoint: str = "customer_booking_checkpoint") -> DataFrame:
    """Q10: totals, success rate and PASSED or FAILED for a run."""
    counted = results.agg(
        rows().cast("int").alias("total_expectations"), F.count_if("success").cast("int").alias("passed_expectations")
    )
    failed = F.col("total_expectations") - F.col("passed_expectations")
    rate = F.round(F.col("passed_expectations") * 100 / F.col("total_expectations"), 2)
    return counted.select(
        F.lit(run_id).alias("run_identifier"),
        F.lit(checkpoint).alias("checkpoint_name"),
        "total_expectations",
        "passed_expectations",
        failed.alias("failed_expectations"),
        rate.alias("success_rate"),
        F.when(failed == 0, "PASSED").otherwise("FAILED").alias("validation_status"),
    )


# -- offending rows -----------------------------------------------------------------------------------------

def repeats(df: DataFrame, checks: Sequence[Rule]) -> dict[str, DataFrame]:
    """Rows of each value, null too, of every column that must be unique: counted once and written."""
    columns = sorted({c.column for c in checks if c.type == UNIQUE and c.column in df.columns})
    return {c: staged(key_counts(df, [c], "_rows"), "value-counts") for c in columns}


def _with_marks(df: DataFrame, counted: dict[str, DataFrame]) -> DataFrame:
    """Mark rows whose checked value repeats; the counts of the values also tell hot ones from others."""
    for column, counts in counted.items():
        repeated = counts.filter(F.col(column).isNotNull() & (F.col("_rows") > 1))
        marks = repeated.select(column, F.lit(True).alias(_mark(column)))
        df = lookup_left_join(df, marks, [column], counted=counts)
    return df


def _applicable(df: DataFrame, checks: Sequence[Rule]) -> list[Rule]:
    return [c for c in checks if c.by_row and c.column in df.columns]


def offending(df: DataFrame, checks: Sequence[Rule], counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every (row, broken rule) pair in one pass: numbers of broken rules are gathered per row, then exploded.

    What a rule says of itself is a table of fixed values by number, so a row that breaks nothing costs its conditions
    alone. ``counted`` are the frame's ``repeats`` where the caller has them.
    """
    checks = _applicable(df, checks)
    none = F.lit(-1)
    broken = F.array(*[F.when(shapes.flag(c.unexpected()), F.lit(i)).otherwise(none) for i, c in enumerate(checks)])
    marked = _with_marks(df, repeats(df, checks) if counted is None else counted)
    pairs = marked.select(*df.columns, F.explode(F.array_remove(broken, none)).alias("_broken"))

    def fixed(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_broken"))

    numbers: dict[str, list[int]] = {}
    for i, c in enumerate(checks):
        numbers.setdefault(c.column, []).append(i)
    value = F.lit(None).cast("string")
    for column, at in numbers.items():
        value = F.when(F.col("_broken").isin(*at), F.col(column).cast("string")).otherwise(value)
    return pairs.select(
        fixed([c.position for c in checks]).alias("position"),
        fixed([c.type for c in checks]).alias("expectation_type"),
        fixed([c.column for c in checks]).alias("column_name"),
        fixed([c.reason for c in checks]).alias("failed_reason"),
        F.coalesce(value, F.lit("None")).alias("failed_value"),
        *df.columns,
    )


def quarantine(df: DataFrame, checks: Sequence[Rule], run_id: str) -> DataFrame:
    """Failed records with reason and value (Q12); table-level rules yield no rows."""
    found = offending(df, checks)
    kept = [c for c in FAILED_RECORD_COLUMNS if c in df.columns]
    return found.select(
        F.lit(run_id).alias("run_identifier"),
        "expectation_type",
        "column_name",
        "failed_reason",
        "failed_value",
        *kept,
    )


def table_failures(results: DataFrame, run_id: str) -> DataFrame:
    """Failed rules that point at no row, recorded once at table level (Q12g)."""
    table_rules = F.col("expectation_type").isin(ROW_COUNT, EXISTS)
    return results.filter(~F.col("success") & table_rules).select(
        F.lit(run_id).alias("run_identifier"),
        "expectation_type",
        F.lit(TABLE_LEVEL).alias("column_name"),
        F.concat(F.lit("Expectation failed: "), "expectation_type").alias("failed_reason"),
    )


def unexpected_values(
    df: DataFrame, checks: Sequence[Rule], sample: int = SAMPLE, counted: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The most frequent offending values per rule with their counts, ``sample`` of each (Q11).

    Values are counted map-side; the per-rule cut is applied before the shuffle as well as after it.
    """
    checks = [c for c in _applicable(df, checks) if c.type != NOT_NULL]
    found = offending(df.select(*sorted({c.column for c in checks})), checks, counted)
    counted = found.groupBy("position", "failed_value").agg(rows().alias("n"))
    ranked = Window.partitionBy("position").orderBy(F.col("n").desc(), "failed_value")
    kept = counted.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= sample)
    gathered = kept.groupBy("position").agg(F.sort_array(F.collect_list(F.struct("rank", "failed_value", "n"))).alias("v"))
    return gathered.select(
        "position",
        F.to_json(F.transform("v", lambda x: x["failed_value"])).alias("partial_unexpected_list"),
        F.to_json(
            F.transform("v", lambda x: F.struct(x["failed_value"].alias("value"), x["n"].alias("count")))
        ).alias("partial_unexpected_counts"),
    )


def expectation_details(df: DataFrame, checks: Sequence[Rule], run_id: str) -> DataFrame:
    """Q11: per-rule metrics with parameters and sampled offending values."""
    spark = df.sparkSession
    parameters = spark.createDataFrame(
        [
            (
                c.position,
                *[None if c.kwargs.get(k) is None else str(c.kwargs[k]) for k in ("min_value", "max_value")],
                c.kwargs.get("regex"),
                json.dumps(c.kwargs["value_set"]) if c.kwargs.get("value_set") else None,
            )
            for c in checks
        ],
        "position int, min_value string, max_value string, regex string, value_set string",
    )
    counted = repeats(df, checks)
    results = run_suite(df, checks, counted)
    joined = results.join(unexpected_values(df, checks, counted=counted), "position", "left").join(parameters, "position", "left")
    empty = F.lit("[]")
    return joined.withColumns(
        {
            "run_identifier": F.lit(run_id),
            "partial_unexpected_list": F.coalesce("partial_unexpected_list", empty),
            "partial_unexpected_counts": F.coalesce("partial_unexpected_counts", empty),
        }
    )
