"""Least squares from running sums, for back-tests and for many series at once.

A day enters a model only through the outer product of its features and target. Those products are summed, by series
and by stretch of days between cut-offs, in one aggregate with map-side combination; a window over the few stretches
makes them running sums; and each fold, or each series, is solved from one such row. No day is copied to the folds
that train on it, and no series is gathered: a task holds ``width ** 2`` numbers a model, however many days it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import forecast as fc

#: Series of fewer days take the shape of the pooled model.
MIN_SERIES_DAYS = fc.MIN_DAYS
#: Numbers are days since this one, so that squares of the trend stay small beside its spread.
ORIGIN = np.datetime64("2000-01-01")


def seasonal_terms(days: Sequence) -> np.ndarray:
    """The features of the forecast: trend and yearly and weekly cycles, a row a day."""
    t = _numbers(days)
    columns = [t / fc.YEAR]
    phase = float((ORIGIN - np.datetime64("1970-01-01")).astype(int))
    for period, k in fc._cycles():
        angle = (t + phase) * (2 * np.pi * k / period)
        columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def weekday_terms(days: Sequence) -> np.ndarray:
    """A small set: trend, and six of the seven weekdays as 0 or 1."""
    t = _numbers(days)
    weekday = ((t + 5) % 7).astype(int)  # 2000-01-01 was a Saturday; Monday is 0
    return np.column_stack([t / fc.YEAR, *[(weekday == d).astype(float) for d in range(6)]])


def _numbers(days: Sequence) -> np.ndarray:
    return (pd.to_datetime(pd.Series(list(days))).to_numpy().astype("datetime64[D]") - ORIGIN).astype("float64")


Terms = Callable[[Sequence], np.ndarray]


def moments(days: DataFrame, by: Sequence[str], terms: Terms = seasonal_terms) -> DataFrame:
    """``by``, ``i, j, v``: sums over the days of a group of all products of ``(1, features, y)``, upper triangle.

    ``days`` holds ``by``, ``ds`` and ``y``. A task adds up its own days before anything is shuffled, in runs of the
    groups it meets; the aggregate joins what tasks have of one group.
    """
    keys = list(by)
    kinds = dict(days.dtypes)
    upper: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = terms(batch["ds"])
            rows = np.column_stack([np.ones(len(x)), x, batch["y"].to_numpy(dtype=float)])
            width = rows.shape[1]
            i, j = upper.setdefault(width, np.triu_indices(width))
            if not keys:
                yield pd.DataFrame({"i": i, "j": j, "v": (rows.T @ rows)[i, j]})
                continue
            # Rows of one group side by side: one product of matrices a group.
            codes, groups = _groups(batch, keys)
            order = np.argsort(codes, kind="stable")
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            for start, end in zip(starts, [*starts[1:], len(order)], strict=True):
                own = rows[order[start:end]]
                sums = (own.T @ own)[i, j]
                named = {k: [groups[codes[order[start]]][n]] * len(i) for n, k in enumerate(keys)}
                yield pd.DataFrame({**named, "i": i, "j": j, "v": sums})

    schema = "".join(f"{k} {kinds[k]}, " for k in keys) + "i int, j int, v double"
    ordered = days.select(*keys, "ds", F.col("y").cast("double").alias("y"))
    return ordered.mapInPandas(added, schema).groupBy(*keys, "i", "j").agg(F.sum("v").alias("v"))


def _groups(batch: pd.DataFrame, keys: Sequence[str]) -> tuple[np.ndarray, list[tuple]]:
    """A number for each row's group, and the groups; a null key is a group of its own."""
    seen: dict[tuple, int] = {}
    values = [tuple(None if pd.isna(v) else v for v in row) for row in batch[list(keys)].itertuples(index=False)]
    return np.array([seen.setdefault(v, len(seen)) for v in values]), list(seen)


def packed(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row a group: its moments as one array, ordered by ``i, j``."""
    cells = F.sort_array(F.collect_list(F.struct("i", "j", "v")))
    return sums.groupBy(*by).agg(cells["v"].alias("moments")) if by else sums.agg(cells["v"].alias("moments"))


def _square(flat: np.ndarray) -> np.ndarray:
    width = int((np.sqrt(8 * len(flat) + 1) - 1) / 2)
    full = np.zeros((width, width))
    full[np.triu_indices(width)] = flat
    return full + np.triu(full, 1).T


class Model:
    """Ridge weights on standardised features, from moments alone; ``ridge`` 0 is plain least squares."""

    def __init__(self, flat: Sequence[float], ridge: float = fc.RIDGE):
        full = _square(np.asarray(flat, dtype=float))
        self.n = full[0, 0]
        mean = full[0] / self.n
        centred = full - self.n * np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(centred)[1:-1], 0) / self.n)
        # What is left of a constant feature after taking off its mean is rounding.
        size = np.sqrt(np.maximum(np.diag(full)[1:-1], 0) / self.n)
        self.scale = np.where(spread > 1e-9 * np.maximum(size, 1e-300), spread, 1.0)
        self.mean, self.level = mean[1:-1], mean[-1]
        gram = centred[1:-1, 1:-1] / np.outer(self.scale, self.scale)
        self.beta = _solve(gram + ridge * self.n * np.eye(len(gram)), centred[1:-1, -1] / self.scale)
        residual = centred[-1, -1] - 2 * self.beta @ (centred[1:-1, -1] / self.scale) + self.beta @ gram @ self.beta
        self.rmse = float(np.sqrt(max(residual, 0.0) / self.n))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.beta + self.level


def _solve(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights; where features depend on each other the smallest ones."""
    try:
        if np.linalg.cond(gram) < 1e12:
            return np.linalg.solve(gram, target)
    except np.linalg.LinAlgError:
        pass
    return np.linalg.lstsq(gram, target, rcond=1e-10)[0]


# -- back-test -----------------------------------------------------------------------------------------------------

def backtest(
    daily: DataFrame,
    period: int = fc.CV_PERIOD,
    horizon: int = fc.CV_HORIZON,
    min_days: int = fc.MIN_DAYS,
    terms: Terms = seasonal_terms,
    ridge: float = fc.RIDGE,
) -> DataFrame:
    """``cutoff, tested, mape`` of each cut-off (M03): the model of all days up to it, tried on the horizon after it.

    Days fall into stretches that end at a cut-off. A stretch is summed once; the sums of a fold are those of all
    stretches up to its cut-off. Only tested days, at most ``horizon / period`` folds each, are copied.
    """
    folds = F.broadcast(fc.cutoffs(daily, period, horizon, min_days).withColumnRenamed("cutoff", "stretch"))
    days = daily.filter(F.col("ds").isNotNull()).select("ds", F.col("y").cast("double").alias("y"))
    # The first cut-off that is not before a day; later days train no fold.
    first = F.expr("array_min(filter(_cuts, c -> c >= ds))")
    cuts = folds.agg(F.collect_list("stretch").alias("_cuts"))
    dated = days.withColumn("_cuts", cuts.scalar()).withColumn("stretch", first).filter(F.col("stretch").isNotNull())
    sums = moments(dated, ["stretch"], terms)
    # Every stretch has every pair, so a window over a pair's stretches has a row for each of them.
    pairs = sums.select("i", "j").distinct()
    grid = folds.crossJoin(pairs).join(sums, ["stretch", "i", "j"], "left").withColumn("v", F.coalesce("v", F.lit(0.0)))
    running = Window.partitionBy("i", "j").orderBy("stretch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    trained = packed(grid.withColumn("v", F.sum("v").over(running)), ["stretch"])
    ahead = F.expr(f"filter(_cuts, c -> c < ds and date_add(c, {horizon}) >= ds)")
    tested = days.withColumn("_cuts", cuts.scalar()).select("ds", "y", F.explode(ahead).alias("stretch"))
    tried = tested.groupBy("stretch").agg(F.sort_array(F.collect_list(F.struct("ds", "y"))).alias("days"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (stretch, *_error(flat, days, terms, ridge))
                for stretch, flat, days in zip(batch["stretch"], batch["moments"], batch["days"], strict=True)
            ]
            yield pd.DataFrame(out, columns=["cutoff", "tested", "mape"])

    joined = trained.join(tried, "stretch", "left")
    return joined.select("stretch", "moments", "days").mapInPandas(run, "cutoff date, tested int, mape double")


def _error(flat, days, terms: Terms, ridge: float) -> tuple[int, float | None]:
    known = [] if days is None else [(d["ds"], d["y"]) for d in days if d["y"] is not None and d["y"] > 0]
    if not known or flat[0] < 2:
        return 0, None
    y = np.array([v for _, v in known])
    guess = np.maximum(Model(flat, ridge).predict(terms([d for d, _ in known])), 0.0)
    return len(known), float((np.abs(guess - y) / y).mean() * 100)


# -- many series ---------------------------------------------------------------------------------------------------

def series_forecast(
    daily: DataFrame,
    by: Sequence[str],
    horizon: int = fc.HORIZON,
    min_days: int = MIN_SERIES_DAYS,
    terms: Terms = seasonal_terms,
    ridge: float = fc.RIDGE,
) -> DataFrame:
    """A forecast for each series of ``daily`` (``by``, ``ds``, ``y``), ``horizon`` dates after the last of all.

    ``by``, ``forecast_date, predicted_bookings, lower_bound, upper_bound, pooled``. A series of fewer than
    ``min_days`` days has the shape of the pooled model, that of all series' days, moved and scaled to the series'
    own mean; ``pooled`` tells. Nothing is below zero. A null key is a series of its own; days without a date or
    value are left out, and an empty table gives no rows.
    """
    keys = list(by)
    known = daily.filter(F.col("ds").isNotNull() & F.col("y").isNotNull())
    own = packed(moments(known, keys, terms), keys)
    everything = moments(known, [], terms)
    pooled = packed(everything, [])
    last = known.agg(F.max("ds").alias("last"))
    framed = own.withColumns({"_pooled": pooled.scalar(), "_last": last.scalar()})
    schema = "".join(f"{k} {dict(daily.dtypes)[k]}, " for k in keys)
    schema += "forecast_date date, predicted_bookings double, lower_bound double, upper_bound double, pooled boolean"
    run = partial(_forecasts, keys=keys, horizon=horizon, min_days=min_days, terms=terms, ridge=ridge)
    return framed.mapInPandas(run, schema)


def _forecasts(
    batches: Iterator[pd.DataFrame], keys: list[str], horizon: int, min_days: int, terms: Terms, ridge: float
) -> Iterator[pd.DataFrame]:
    shared: tuple | None = None
    for batch in batches:
        for row in batch.itertuples(index=False):
            named = dict(zip(batch.columns, row, strict=True))
            if shared is None:
                dates = pd.date_range(pd.Timestamp(named["_last"]) + pd.Timedelta(days=1), periods=horizon)
                model = Model(named["_pooled"], ridge)
                shared = dates, terms(dates), model, model.predict(terms(dates))
            dates, x, model, base = shared
            flat = named["moments"]
            short = flat[0] < min_days
            if short:
                width = int((np.sqrt(8 * len(flat) + 1) - 1) / 2)
                share = (flat[width - 1] / flat[0]) / model.level if model.level else 0.0
                guess, rmse = base * share, model.rmse * abs(share)
            else:
                fitted = Model(flat, ridge)
                guess, rmse = fitted.predict(x), fitted.rmse
            spread = fc.INTERVAL_Z * rmse
            yield pd.DataFrame(
                {
                    **{k: [named[k]] * horizon for k in keys},
                    "forecast_date": dates.date,
                    "predicted_bookings": np.maximum(guess, 0.0),
                    "lower_bound": np.maximum(guess - spread, 0.0),
                    "upper_bound": np.maximum(guess + spread, 0.0),
                    "pooled": [bool(short)] * horizon,
                }
            )


def series_counts(df: DataFrame, by: Sequence[str], day: str = "booking_date") -> DataFrame:
    """Rows of each series and date: ``by``, ``ds``, ``y``."""
    dated = df.filter(F.col(day).isNotNull())
    return dated.groupBy(*by, F.col(day).alias("ds")).agg(F.count(F.lit(1)).alias("y"))
