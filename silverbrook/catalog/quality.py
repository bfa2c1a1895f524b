"""Data-quality queries: Q01-Q12."""

from __future__ import annotations

from ..contracts import FAILED_RECORD_COLUMNS
from ..plans import quality as q
from .base import register

SUITE = q.suite(q.booking_suite())


def _of(*types: str) -> list[q.Rule]:
    return [r for r in SUITE if r.type in types]


def _broken(r: q.Rule) -> str:
    """SQL condition of a row that breaks a rule."""
    c = r.column
    if r.type == q.NOT_NULL:
        return f"{c} IS NULL"
    if r.type == q.UNIQUE:
        return f"{c} IN (SELECT {c} FROM f_serving GROUP BY {c} HAVING count(*) > 1)"
    if r.type == q.IN_SET:
        return f"{c} NOT IN ({', '.join(repr(v) for v in r.kwargs['value_set'])})"
    if r.type == q.REGEX:
        return f"NOT regexp_matches({c}, '{r.kwargs['regex']}')"
    return f"{c} < {r.kwargs['min_value']}"


def _result_sql(r: q.Rule) -> str:
    head = f"SELECT {r.position} AS position, '{r.type}' AS expectation_type, '{r.column}' AS column_name"
    if r.type == q.ROW_COUNT:
        low, high = r.kwargs["min_value"], r.kwargs["max_value"]
        return f"""{head}, count(*) BETWEEN {low} AND {high} AS success, CAST(count(*) AS VARCHAR) AS observed_value,
                   0 AS element_count, 0 AS missing_count, 0 AS unexpected_count FROM f_serving"""
    if r.type == q.EXISTS:
        return f"""{head}, TRUE AS success, CAST(NULL AS VARCHAR) AS observed_value, 0 AS element_count, 0 AS missing_count,
                   0 AS unexpected_count"""
    missing = "0" if r.type == q.NOT_NULL else f"count(*) FILTER ({r.column} IS NULL)"
    return f"""{head}, count(*) FILTER ({_broken(r)}) = 0 AS success, CAST(NULL AS VARCHAR) AS observed_value, count(*) AS element_count,
               {missing} AS missing_count, count(*) FILTER ({_broken(r)}) AS unexpected_count FROM f_serving"""


def suite_sql(checks: list[q.Rule]) -> str:
    def pct(part: str, whole: str) -> str:
        return f"CASE WHEN {whole} > 0 THEN round({part} * 100.0 / ({whole}), 4) ELSE 0.0 END"

    present = "(element_count - missing_count)"
    union = "\nUNION ALL ".join(_result_sql(r) for r in checks)
    return f"""SELECT *, {pct('missing_count', 'element_count')} AS missing_percent,
                      {pct('unexpected_count', present)} AS unexpected_percent,
                      {pct('unexpected_count', 'element_count')} AS unexpected_percent_total,
                      {pct('unexpected_count', present)} AS unexpected_percent_nonmissing FROM ({union})"""


for _key, _types in {
    "q01_row_count": (q.ROW_COUNT,),
    "q02_columns_exist": (q.EXISTS,),
    "q03_not_null": (q.NOT_NULL,),
    "q04_unique": (q.UNIQUE,),
    "q05_regex": (q.REGEX,),
    "q06_in_set": (q.IN_SET,),
    "q07_between": (q.BETWEEN,),
}.items():
    register(_key, lambda f, t=_types: q.run_suite(f.mart, _of(*t)), suite_sql(_of(*_types)))

# Keys of the bookings and of their parts, and a column that repeats: four rules, one exchange.
MANY_UNIQUE = q.suite(
    [{"type": q.UNIQUE, "kwargs": {"column": c}} for c in ("booking_id", "payment_id", "car_id", "customer_id")]
)
register("q04_many_unique", lambda f: q.run_suite(f.mart, MANY_UNIQUE), suite_sql(MANY_UNIQUE))

register("q09_run_suite", lambda f: q.run_suite(f.mart, SUITE), suite_sql(SUITE))


def _summary_sql(run_id: str) -> str:
    return f"""SELECT '{run_id}' AS run_identifier, 'customer_booking_checkpoint' AS checkpoint_name, total_expectations,
                      passed_expectations, total_expectations - passed_expectations AS failed_expectations,
                      round(passed_expectations * 100.0 / total_expectations, 2) AS success_rate,
                      CASE WHEN passed_expectations = total_expectations THEN 'PASSED' ELSE 'FAILED' END
                        AS validation_status
               FROM (SELECT count(*) AS total_expectations, count(*) FILTER (success) AS passed_expectations
                     FROM ({suite_sql(SUITE)}))"""


LOADED = q.booking_suite() + [{"type": "expect_something_unheard_of", "kwargs": {"column": "email"}}]
register(
    "q08_loaded_suite",
    lambda f: q.run_summary(q.run_suite(f.mart, q.suite(LOADED)), "loaded"),
    _summary_sql("loaded"),
)
register("q10_run_summary", lambda f: q.run_summary(q.run_suite(f.mart, SUITE), "run_1"), _summary_sql("run_1"))


def _sql_text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _quarantine_part(r: q.Rule) -> str:
    return f"""SELECT 'run_1' AS run_identifier, '{r.type}' AS expectation_type, '{r.column}' AS column_name,
                      {_sql_text(r.reason)} AS failed_reason, coalesce(CAST({r.column} AS VARCHAR), 'None') AS failed_value,
                      {', '.join(FAILED_RECORD_COLUMNS)} FROM f_serving WHERE {_broken(r)}"""


def quarantine_sql(checks: list[q.Rule]) -> str:
    return "\nUNION ALL ".join(_quarantine_part(r) for r in checks if r.by_row)


register("q12_quarantine", lambda f: q.quarantine(f.mart, SUITE, "run_1"), quarantine_sql(SUITE))
for _key, _types in {
    "q12a_quarantine_unique": (q.UNIQUE,),
    "q12b_quarantine_null": (q.NOT_NULL,),
    "q12c_quarantine_in_set": (q.IN_SET,),
    "q12d_quarantine_regex": (q.REGEX,),
}.items():
    register(_key, lambda f, t=_types: q.quarantine(f.mart, _of(*t), "run_1"), quarantine_sql(_of(*_types)))

# The published bounds never fail on clean amounts, so the range forms run with bounds of their own.
RANGES = q.suite(
    [
        {"type": q.BETWEEN, "kwargs": {"column": "pickup_hour", "min_value": 6, "max_value": 20}},
        {"type": q.BETWEEN, "kwargs": {"column": "loyalty_rank", "min_value": 2}},
        {"type": q.BETWEEN, "kwargs": {"column": "booking_year", "max_value": 1999}},
    ]
)
RANGE_CASES = [
    ("pickup_hour < 6 OR pickup_hour > 20", RANGES[0]),
    ("loyalty_rank < 2", RANGES[1]),
    ("booking_year > 1999", RANGES[2]),
]
CASTS = q.suite(
    [
        {"type": q.LESS, "kwargs": {"column": "pickup_time", "max_value": 11}},
        {"type": q.GREATER, "kwargs": {"column": "loyalty_points", "min_value": 1000}},
    ]
)
CAST_CASES = [
    ("TRY_CAST(pickup_time AS DOUBLE) > 11", CASTS[0]),
    ("TRY_CAST(loyalty_points AS DOUBLE) < 1000", CASTS[1]),
]
KEYS = "booking_id, car_id, payment_id"


def _range_sql(cases: list[tuple[str, q.Rule]]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{r.column}' AS column_name, {_sql_text(r.reason)} AS failed_reason,
                   CAST({r.column} AS VARCHAR) AS failed_value, {KEYS} FROM f_serving WHERE {condition}"""
        for condition, r in cases
    )


def _range_rows(f, checks: list[q.Rule]):
    return q.offending(f.mart, checks).select("column_name", "failed_reason", "failed_value", *KEYS.split(", "))


register("q12e_quarantine_between", lambda f: _range_rows(f, RANGES), _range_sql(RANGE_CASES))
register("q12f_quarantine_numeric_text", lambda f: _range_rows(f, CASTS), _range_sql(CAST_CASES))
SMALL_TABLE = q.suite([{"type": q.ROW_COUNT, "kwargs": {"min_value": 1, "max_value": 10}}])
register(
    "q12g_table_failures",
    lambda f: q.table_failures(q.run_suite(f.mart, SMALL_TABLE), "run_1"),
    f"""SELECT 'run_1' AS run_identifier, '{q.ROW_COUNT}' AS expectation_type, 'table_level' AS column_name,
               'Expectation failed: {q.ROW_COUNT}' AS failed_reason
        FROM (SELECT count(*) AS n FROM f_serving) WHERE n > 10""",
)


def _details_sql() -> str:
    sampled = "\nUNION ALL ".join(
        f"SELECT {r.position} AS position, CAST({r.column} AS VARCHAR) AS v, count(*) AS n FROM f_serving "
        f"WHERE {_broken(r)} GROUP BY {r.column}"
        for r in SUITE
        if r.by_row and r.type != q.NOT_NULL
    )
    parameters = ", ".join(
        f"({r.position}, {_sql_text(r.kwargs.get('min_value'))}, {_sql_text(r.kwargs.get('max_value'))}, "
        f"{_sql_text(r.kwargs.get('regex'))}, {_value_set(r)})"
        for r in SUITE
    )
    return f"""
SELECT 'run_1' AS run_identifier, r.*, min_value, max_value, regex, value_set,
       coalesce(partial_unexpected_list, '[]') AS partial_unexpected_list,
       coalesce(partial_unexpected_counts, '[]') AS partial_unexpected_counts
FROM ({suite_sql(SUITE)}) r
JOIN (VALUES {parameters}) p(position, min_value, max_value, regex, value_set) ON r.position = p.position
LEFT JOIN (SELECT position, '[' || string_agg('"' || v || '"', ',' ORDER BY k) || ']' AS partial_unexpected_list,
                  '[' || string_agg('{{"value":"' || v || '","count":' || CAST(n AS VARCHAR) || '}}', ',' ORDER BY k) || ']'
                    AS partial_unexpected_counts
           FROM (SELECT *, row_number() OVER (PARTITION BY position ORDER BY n DESC, v) AS k FROM ({sampled}))
           WHERE k <= 20 GROUP BY position) s ON r.position = s.position"""


def _value_set(r: q.Rule) -> str:
    values = r.kwargs.get("value_set")
    return "NULL" if not values else "'[" + ", ".join(f'"{v}"' for v in values) + "]'"


register("q11_expectation_details", lambda f: q.expectation_details(f.mart, SUITE, "run_1"), _details_sql())
