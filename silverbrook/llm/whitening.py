"""Whitening of vectors with a covariance from variances alone (operator 11).

Polarisation: the variance of a sum is the two variances plus twice the covariance. So for every dimension, and for
every sum of two dimensions, only squared centred values are added up, as exact integers; differences give all
cross-covariances, exactly, and the assembled matrix goes to ``eigh``.

Vectors become integers ``floor(256 * c)`` and are centred on the rounded mean before squaring; what rounding the mean
leaves is taken off in integers at the end, so covariances are fractions of integers and do not depend on the order of
rows, tasks or retries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

COMPONENTS = 4
#: Sums of squares below this stay exact in 64 bits; beyond it integers of any size take over.
_EXACT = 1 << 62
#: Vectors of one block: its sums of two dimensions are made one dimension at a time.
_BLOCK = 2_048
_DIGIT = 40


def integers(embedding: Column) -> Column:
    """``floor(256 * c)`` of each entry as long; beyond the range of a long the nearest end of it."""
    return F.transform(embedding.cast("array<double>"), lambda c: F.floor(c * 256.0))


def usable(embedding: Column) -> Column:
    """Whether a vector takes part: not null, every entry known and finite."""
    fine = F.forall(
        embedding.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return embedding.isNotNull() & F.coalesce(fine, F.lit(False))


@dataclass(frozen=True)
class Whitening:
    """What one pass over the fit list leaves, for vectors of one width; some ``8 * width * components`` bytes."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray  # (width, components), unit columns by falling eigenvalue
    values: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """One over the deviation; 0 for a component without variance, on which all of the fit list is 0."""
        with np.errstate(divide="ignore"):
            return np.where(self.values > 0, 1 / np.sqrt(self.values), 0.0)

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.zeros_like(self.values)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in double: the whole part of the mean is taken off as integer, the rest after."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums), strict=True)
        return subtracted(x, list(whole)).astype(np.float64) - np.array([float(Fraction(r, self.n)) for r in rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        # Sums in a fixed order a row: a row's result does not depend on the rows beside it.
        y = self.centred(x)
        return np.stack([(y * d).sum(axis=1) for d in self.directions.T], axis=1) * self.scales

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n * x - S) ** 2)`` of each row, exact; None where it is no long."""
        most = int(np.abs(x.astype(object)).max(initial=0)) if x.dtype == object else int(max(abs(int(x.min())), abs(int(x.max()))))
        reach = self.n * most + max(map(abs, self.sums))
        if reach * reach * x.shape[1] < _EXACT:
            c = self.n * x - np.array(self.sums, dtype=np.int64)
            return np.einsum("ij,ij->i", c, c).tolist()
        c = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return [d if d < 1 << 63 else None for d in (c * c).sum(axis=1)]


def subtracted(x: np.ndarray, whole: list[int]) -> np.ndarray:
    """``x - whole`` without overflow: in 64 bits where both sides leave room, else in integers of any size."""
    if not x.size or max(-int(x.min()), int(x.max()), *map(abs, whole)) < _EXACT:
        return x - np.array(whole, dtype=np.int64)
    return x.astype(object) - np.array(whole, dtype=object)


def pair_sums(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact ``sum(y_i)`` and ``sum((y_i + y_j) ** 2)`` over rows, for all ``i <= j``; for ``i = j`` of ``y_i`` alone.

    Pairs come row by row of the upper triangle, as integers of any size.
    """
    width = y.shape[1]
    most = int(max(-int(y.min()), int(y.max()))) if y.size else 0
    if 4 * most * most * max(len(y), 1) >= _EXACT:
        y = y.astype(object)
    squares = []
    for i in range(width):
        own, both = y[:, i], y[:, i + 1 :] + y[:, i : i + 1]
        squares += [(own * own).sum(), *(both * both).sum(axis=0)]
    return np.array([int(s) for s in y.sum(axis=0)], dtype=object), np.array([int(s) for s in squares], dtype=object)


def digits(value: int) -> list[tuple[int, int]]:
    """``(place, digit)`` of an integer in base 2 ** 40, digits with its sign; 0 has one digit."""
    sign, rest, found = (-1 if value < 0 else 1), abs(int(value)), []
    while rest or not found:
        rest, digit = divmod(rest, 1 << _DIGIT)
        found.append((len(found), sign * digit))
    return found


def covariance(n: int, totals: list[int], squares: list[int]) -> list[list[Fraction]]:
    """The exact covariance from sums and squared sums of one and two dimensions, divisor ``n``."""
    width = len(totals)
    at = iter(squares)
    spread: dict[tuple[int, int], int] = {}
    for i in range(width):
        for j in range(i, width):
            total = totals[i] if i == j else totals[i] + totals[j]
            spread[i, j] = n * next(at) - total * total  # n * n times a variance
    matrix = [[Fraction(0)] * width for _ in range(width)]
    for i in range(width):
        matrix[i][i] = Fraction(spread[i, i], n * n)
        for j in range(i + 1, width):
            matrix[i][j] = matrix[j][i] = Fraction(spread[i, j] - spread[i, i] - spread[j, j], 2 * n * n)
    return matrix


def principal(n: int, sums: list[int], matrix: list[list[Fraction]], components: int) -> Whitening:
    """Components by falling eigenvalue, the largest entry of each made positive.

    Eigenvalues that are nothing but the rounding of ``eigh`` count as 0.
    """
    exact = np.array([[float(v) for v in row] for row in matrix])
    trace = float(sum(matrix[i][i] for i in range(len(matrix))))
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    values = np.where(values > trace * len(matrix) * np.finfo(float).eps, values, 0.0)
    lead = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[lead, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, tuple(sums), vectors, values, trace)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _of_width(batches: Iterator[pa.RecordBatch], width: int, at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(start, _BLOCK)
            yield part, _matrix(part.column(at), width)


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of a fit list: ``x``, one row a distinct vector of ``width`` longs.

    Two passes. The first counts and adds up; the second gives, a task, one row for every dimension and pair of
    dimensions, however many vectors it read. What reaches the driver has ``width * (width + 1) / 2`` rows.
    """
    first = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")
    )
    rows = sorted(first.collect())
    n, sums = rows[0].n, [int(r.s) for r in rows]
    centre = [round(Fraction(s, n)) for s in sums]
    pairs = width * (width + 1) // 2

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, squares = np.zeros(width, dtype=object), np.zeros(pairs, dtype=object)
        for _, x in _of_width(batches, width, 0):
            total, square = pair_sums(subtracted(x, centre))
            totals, squares = totals + total, squares + square
        # Integers of any size as digits of 40 bits: their sums over tasks stay longs.
        found = [(at, *d) for at, v in enumerate([*totals, *squares]) for d in digits(v)]
        columns = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64()), strict=True)],
            names=["at", "digit", "v"],
        )

    parts = distinct.mapInArrow(added, "at int, digit int, v bigint").groupBy("at", "digit").agg(F.sum("v").alias("v"))
    exact = [0] * (width + pairs)
    for r in parts.collect():
        exact[r["at"]] += r.v << (_DIGIT * r.digit)
    return principal(n, sums, covariance(n, exact[:width], exact[width:]), components)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, over components with variance."""
    width, live = len(model.sums), np.flatnonzero(model.values > 0)
    if not len(live):
        return 0.0
    upper = np.triu_indices(len(live))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(len(live)), np.zeros((len(live), len(live)))
        for _, x in _of_width(batches, width, 0):
            z = model.whitened(x)[:, live]
            total, product = total + z.sum(axis=0), product + z.T @ z
        found = [*total, *product[upper]]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(found)], names=["at", "v"])

    # Means are 0 but for rounding: nothing cancels when they are taken off.
    parts = distinct.mapInArrow(products, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    found = np.array([r.v for r in sorted(parts.collect())]) / model.n
    mean, second = found[: len(live)], np.zeros((len(live), len(live)))
    second[upper] = found[len(live) :]
    second -= np.triu(np.outer(mean, mean))
    return float(np.abs(second - np.eye(len(live)))[upper].max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each vector and leading component.

    Rows whose vector is null or holds null or non-finite entries are dropped. The fit list holds each distinct integer
    vector once, however many rows share it; every remaining row is returned, repeated rows, repeated ids and null ids
    as well. Vectors of another width are another space: each width is fitted by itself. A vector of fewer dimensions
    than ``components`` has as many components as dimensions, an empty one none. A component without variance (one
    distinct vector, or fewer than components) gives 0 for ``whitened`` and ``explained`` and is left out of
    ``identity_error``. Of equal eigenvalues any basis may come first. ``deviation`` is null beyond the range of a
    long. An empty table gives no rows; other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(usable(F.col("embedding"))).select("vec_id", integers(F.col("embedding")).alias("x"))
    rows = rows.where(F.size("x") > 0)
    # Equal vectors meet once a task before they are shuffled.
    distinct = common.written(rows.select("x").distinct(), "fit-list")
    widths = [r.w for r in distinct.select(F.size("x").alias("w")).distinct().orderBy("w").collect()]
    schema = (
        "vec_id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    ).format(dict(rows.dtypes)["vec_id"])
    out = spark.createDataFrame([], schema)
    for width in widths:
        own = distinct.where(F.size("x") == width)
        model = fit(own, width, components)
        part = rows.where(F.size("x") == width).mapInArrow(_applied(model, identity_error(own, model)), schema)
        out = part if len(widths) == 1 else out.unionByName(part)
    return out


def _applied(model: Whitening, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, explained = len(model.values), model.explained
        for part, x in _of_width(batches, len(model.sums), 1):
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, dtype=np.int64)),
                    pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run
