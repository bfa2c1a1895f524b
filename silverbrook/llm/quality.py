"""Document quality by regularised quadratic discriminant analysis (operator 3).

Each whole text gives a dozen transformed statistics. Class means and covariances come from one aggregate over all
learnable labelled rows; covariances shrink towards the pooled one and its diagonal. The score is the posterior of
label 1: the difference of the two Gaussian log densities, measured with Cholesky factors computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

STATISTICS = (
    "words", "word_length", "distinct", "pairs", "twice", "lines", "upper", "symbols", "marks", "bars", "digits", "stops",
)
POOLED, DIAGONAL = 0.1, 0.05
THRESHOLD = 0.3
#: Log density differences are divided by this before they become a probability: Gaussians are too sure of tails.
TEMPERATURE = 4.0


def _class_of_byte() -> np.ndarray:
    kind = np.zeros(256, dtype=np.int64)
    for group, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#$%&*+/<=>@\\^_`~{}[]", "!?", "|", ".,;:"), 1):
        for c in chars.encode():
            kind[c] = group
    return kind


_KIND = _class_of_byte()


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of a whole text; an empty one has those of no words."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    upper, digits, symbols, marks, bars, stops = np.bincount(_KIND[raw], minlength=7)[1:]
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x]
    n, letters = len(words), max(1, len(raw))
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    twice = sum(map(str.__eq__, words, words[1:]))
    share = np.array(
        [
            np.log1p(n),
            np.log1p(letters / max(1, n)),
            np.log((distinct + 1) / (n + 1)) / np.log(n + 2),
            np.log((pairs + 1) / (max(0, n - 1) + 1)),
            np.log1p(1000 * twice / max(1, n)),
            np.log((len(set(lines)) + 1) / (len(lines) + 1)),
            *np.log1p(1000 * np.array([upper, symbols, marks, bars, digits, stops]) / letters),
        ]
    )
    return share


def with_statistics(docs: DataFrame, column: str, text_stays: bool) -> DataFrame:
    """``docs`` with an array of statistics added; without its text unless ``text_stays``."""
    at = docs.columns.index("text")
    keep = [i for i in range(len(docs.columns)) if text_stays or i != at]
    fields = [docs.schema.fields[i] for i in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, "text"):
            rows = [statistics(t) for t in batch.column(at).to_pylist()]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(rows)), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), lists], names=[*(f.name for f in fields), column])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(column, T.ArrayType(T.DoubleType()))]))


@dataclass
class Gaussians:
    """Means and inverse Cholesky factors of both classes, and the log odds that do not depend on the text."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    constant: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), 1 / (1 + np.exp(-self.constant)))
        squares = [(((x - m) @ f.T) ** 2).sum(axis=1) for m, f in zip(self.means, self.factors, strict=True)]
        logit = ((squares[0] - squares[1]) / 2 + self.constant) / TEMPERATURE
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def fit(measured: DataFrame, labels: DataFrame, column: str) -> Gaussians:
    """Gaussians of all rows that may be learned from; one label alone gives a constant score."""
    known = common.labelled(labels, "quality").where(~common.held_out())
    rows = measured.select("doc_id", column).join(known, "doc_id")
    d = len(STATISTICS)
    x = [F.col(column)[i] for i in range(d)]
    sums = [F.sum(v) for v in x] + [F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d)]
    found = {r[0]: r[1:] for r in rows.groupBy("label").agg(F.count(F.lit(1)), *sums).collect()}
    counts = [found[c][0] if c in found else 0 for c in (0, 1)]
    if min(counts) < 2:
        return Gaussians(None, None, float(np.log((counts[1] + 1) / (counts[0] + 1))))
    means, scatters = [], []
    for c in (0, 1):
        n, values = found[c][0], np.array(found[c][1:], dtype=float)
        mean, square = values[:d] / n, np.zeros((d, d))
        square[np.triu_indices(d)] = values[d:] / n
        means.append(mean)
        scatters.append(np.triu(square) + np.triu(square, 1).T - np.outer(mean, mean))
    pooled = sum(n * s for n, s in zip(counts, scatters, strict=True)) / sum(counts)
    factors, logs = [], []
    for s in scatters:
        mixed = (1 - POOLED) * s + POOLED * pooled
        mixed = (1 - DIAGONAL) * mixed + DIAGONAL * np.diag(np.diag(pooled)) + 1e-6 * np.eye(d)
        lower = np.linalg.cholesky(mixed)
        factors.append(np.linalg.inv(lower))
        logs.append(np.log(np.diag(lower)).sum())
    constant = logs[0] - logs[1] + np.log(counts[1] / counts[0])
    return Gaussians(tuple(means), tuple(factors), float(constant))


def quality_scores(docs: DataFrame, labels: DataFrame, text_stays: bool = False) -> DataFrame:
    """``docs`` (without its text unless ``text_stays``) with ``held_out``, ``score`` and ``predicted`` added.

    ``score`` is the posterior of label 1 and ``predicted`` is 1 from ``THRESHOLD`` on. Only text statistics enter
    a score. Null and empty texts have the statistics of no words and a score like any other. Labels are learned
    only where ``crc32(doc_id)`` mod 5 is not 0; repeated labels of an id count as their mean, rows of one id are
    scored each on its own, and a null id is never held out. Without labels of both kinds all scores are one
    constant. Names that are taken get ``_`` before.
    """
    column = common.free_name(docs, "statistics")
    measured = common.written(with_statistics(docs, column, text_stays), "quality-statistics")
    model = fit(measured, labels, column)
    names = [common.free_name(docs, n) for n in ("held_out", "score", "predicted")]

    @F.pandas_udf("double")
    def score(x):
        return __import__("pandas").Series(model.score(np.stack(x.to_numpy())) if len(x) else [])

    return (
        measured.withColumn(names[0], common.held_out())
        .withColumn(names[1], score(column))
        .withColumn(names[2], (F.col(names[1]) >= THRESHOLD).cast("int"))
        .drop(column)
    )
