"""Numeric features of the serving table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...operators.keyed import HOT_ROWS, cell_join, fan_out_left_join, hot_slices, lookup_left_join
from ...operators.ranks import dense_codes
from ...operators.ranks import with_codes as attach_codes

# Which columns the published models read.
CATEGORIES = [
    "loyalty_tier", "payment_method", "insurance_coverage", "model", "trip_type", "car_segment", "amount_tier",
    "price_tier", "points_tier", "pickup_slot", "insurer_type",
]
FLAGS = ["is_high_value_customer", "has_full_insurance", "is_digital_payment", "is_split_payment"]
NUMBERS = [
    "payment_amount", "price_per_day", "loyalty_points", "loyalty_rank", "pickup_hour", "payment_count",
    "booking_month",
]
FRAUD_FEATURES = NUMBERS + [
    "loyalty_tier", "payment_method", "insurance_coverage", "model", "trip_type", "car_segment", "amount_tier",
    "price_tier",
] + FLAGS
CHURN_FEATURES = NUMBERS + [
    "days_since_last_booking", "loyalty_tier", "payment_method", "trip_type", "car_segment", "amount_tier",
    "price_tier", "points_tier",
] + FLAGS
MISSING_TEXT = "None"


def code_name(column: str) -> str:
    return f"{column}_code"


def _texts(columns: Sequence[str]) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT)) for c in columns}


def fit_codes(df: DataFrame, columns: Sequence[str], *more: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Alphabetical codes of category columns as a written table ``name, value, code``; no value meets the driver.

    ``more`` are further frames, each with the columns it is read for.
    """
    (first, names), *rest = [
        (frame.select(*[text.alias(c) for c, text in _texts(names).items()]), names)
        for frame, names in [(df, columns), *more]
    ]
    return dense_codes(first, names, *rest)


def with_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach ``<column>_code``; values that ``codes`` does not know share the code after the last."""
    return attach_codes(df, codes, _texts(columns))


def curated_codes(
    booking: DataFrame,
    customer: DataFrame,
    cars: DataFrame,
    payments: DataFrame,
    categories: Sequence[str],
    keep: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``keep`` and the codes of ``categories`` for every row of the curated table, fitted on that table.

    Equal to ``with_codes`` of that table by its own ``fit_codes``, but a booking's cars and payments are multiplied
    only once, and as codes. A value is in the table if it is in the join of bookings with cars or with payments
    alone, so the codes are fitted on these; values are looked up in the entities. Where a booking has no car or no
    payment, the missing text stands for theirs.
    """
    key = "booking_id"
    people = lookup_left_join(booking, customer, ["customer_id"], hot_rows)
    wanted = [*keep, *categories]
    sides = [s.select(key, *[c for c in wanted if c in s.columns and c != key]) for s in (people, cars, payments)]
    own = [[c for c in categories if c in s.columns and (c != key or i == 0)] for i, s in enumerate(sides)]
    hot = hot_slices(sides, key, hot_rows)

    def met(child: DataFrame) -> DataFrame:
        """Bookings with one child; where no key is hot with both, none is with one."""
        ids = sides[0].select(key)
        return cell_join(ids, [child], key, None) if hot is None else fan_out_left_join(ids, [child], key, hot_rows)

    parts = [(frame, names) for frame, names in zip([sides[0], *map(met, sides[1:])], own, strict=True) if names]
    codes = fit_codes(*parts[0], *parts[1:])
    coded = [with_codes(side, codes, names).drop(*set(names) - set(keep)) for side, names in zip(sides, own, strict=True)]
    wide = cell_join(coded[0], coded[1:], key, hot)
    # At most one row a column.
    missing = {r["name"]: r["code"] for r in codes.filter(F.col("value") == MISSING_TEXT).collect()}
    filled = [F.coalesce(code_name(c), F.lit(missing.get(c, 0))).alias(code_name(c)) for c in categories]
    return wide.select(*keep, *filled)


def assemble(df: DataFrame, features: Sequence[str], codes: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Add the ``features`` vector: codes for categories, 0/1 for flags, zero for what is missing."""
    present = [c for c in features if c in df.columns]
    coded = with_codes(df, codes, categories)
    numeric = {
        f"_f_{c}": F.coalesce(F.col(code_name(c) if c in categories else c).cast("double"), F.lit(0.0))
        for c in present
    }
    assembler = VectorAssembler(inputCols=list(numeric), outputCol="features")
    return assembler.transform(coded.withColumns(numeric)).drop(*numeric, *[code_name(c) for c in categories])
