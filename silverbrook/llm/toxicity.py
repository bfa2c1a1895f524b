"""Severity of toxic language by cumulative-link ordinal regression (operator 9).

Words that tell toxic from other labelled texts are found from counts of distinct texts over all learnable rows, so
that copies are no evidence; all of them are kept, and their counts in a text are its sparse features. Grades are ordered: 0 for texts labelled clean, 1 and 2 for toxic ones
with fewer or more telling words. One weight vector serves every threshold, ``P(grade > k) = logistic(w.x - t_k)``
with ``t_0 < t_1``; the expected grade is the severity.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Evidence (log-likelihood ratio against independence) a word must have to be a feature.
EVIDENCE = 30.0
#: Telling words in a toxic text from which its grade is 2.
SEVERE = 3
#: Labelled texts the regression is fitted on, those with the smallest digests of their ids. Word counts use all.
SAMPLE = 40_000
PENALTY = 0.05
THRESHOLD = 0.5


class SparseRows:
    """Rows of logarithmic counts, for products with vectors from the right."""

    def __init__(self, shape: tuple[int, int], row: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.shape, self.row, self.column, self.value = shape, row, column, value

    def __len__(self) -> int:
        return self.shape[0]

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.column], minlength=self.shape[0])

    @property
    def T(self) -> SparseRows:
        return SparseRows(self.shape[::-1], self.column, self.row, self.value)


@dataclass
class OrdinalModel:
    words: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, x: np.ndarray | SparseRows) -> np.ndarray:
        """``P(grade > k)`` for each row and threshold."""
        eta = x @ self.weights
        return 1 / (1 + np.exp(-np.clip(eta[:, None] - self.thresholds, -500, 500)))


def features(text: str | None, words: dict[bytes, int]) -> dict[int, int]:
    """Counts of feature words in a whole text."""
    counts = Counter(common.words(text)) if text else {}
    return {words[w]: c for w, c in counts.items() if w in words} if len(words) > len(counts) else {
        i: counts[w] for w, i in words.items() if w in counts
    }


def sparse(rows: list[dict[int, int]], width: int) -> SparseRows:
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows]).astype(np.int64)
    column = np.fromiter((j for r in rows for j in r), np.int64, len(row))
    value = np.log1p(np.fromiter((c for r in rows for c in r.values()), np.float64, len(row)))
    return SparseRows((len(rows), width), row, column, value)


def telling_words(texts: DataFrame) -> list[bytes]:
    """All words with evidence for label 1, from distinct ``text, label`` rows; strongest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, "text"):
            seen: dict[bytes, list[int]] = {}
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word in set(common.words(text)) if text else ():
                    seen.setdefault(word, [0, 0])[label] += 1
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.binary()), *(pa.array([c[k] for c in seen.values()], pa.int64()) for k in (0, 1))],
                    names=["word", "clean", "toxic"],
                )

    totals = {r.label: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return []
    counts = texts.mapInArrow(count, "word binary, clean bigint, toxic bigint")
    counts = counts.groupBy("word").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    n = clean + toxic
    seen = F.col("t") + F.col("c")
    cells = [
        (F.col("t"), seen * toxic / n),
        (F.col("c"), seen * clean / n),
        (toxic - F.col("t"), (n - seen) * toxic / n),
        (clean - F.col("c"), (n - seen) * clean / n),
    ]
    evidence = sum(F.when((x > 0) & (e > 0), x * F.log(x / e)).otherwise(0.0) for x, e in cells) * 2
    strong = counts.where(F.col("t") * clean > F.col("c") * toxic).withColumn("z", evidence).where(F.col("z") >= EVIDENCE)
    return [bytes(r.word) for r in strong.orderBy(F.desc("z"), "word").collect()]


def fit_ordinal(x: np.ndarray | SparseRows, grades: np.ndarray, weight: np.ndarray, top: int = 2, rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps with momentum on the penalised likelihood.

    Thresholds are a first one and a positive gap, held as its logarithm, so their order cannot break.
    """
    w, first, gap = np.zeros(x.shape[1]), 1.0, np.zeros(top - 1)
    total = weight.sum()
    moment = [np.zeros_like(w), 0.0, np.zeros_like(gap)]
    second = [np.zeros_like(w), 0.0, np.zeros_like(gap)]
    for step in range(1, rounds + 1):
        t = first + np.concatenate([[0], np.cumsum(np.exp(gap))])
        up = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - t, -500, 500)))
        padded = np.concatenate([np.ones((len(x), 1)), up, np.zeros((len(x), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(x), 1)), up * (1 - up), np.zeros((len(x), 1))], axis=1)
        i = np.arange(len(x))
        p = np.maximum(padded[i, grades] - padded[i, grades + 1], 1e-12)
        d_eta = weight * (slope[i, grades] - slope[i, grades + 1]) / p / total
        d_t = np.zeros((len(x), top + 2))
        d_t[i, grades] -= slope[i, grades] / p * weight / total
        d_t[i, grades + 1] += slope[i, grades + 1] / p * weight / total
        d_t = d_t[:, 1 : top + 1].sum(axis=0)
        tail = np.cumsum(d_t[::-1])[::-1]
        gradient = [x.T @ d_eta - PENALTY / total * w, tail[0], tail[1:] * np.exp(gap)]
        for k, g in enumerate(gradient):
            moment[k] = 0.9 * moment[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g**2
        steps = [0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8) for m, s in zip(moment, second, strict=True)]
        w, first, gap = w + steps[0], first + steps[1], gap + steps[2]
    return w, first + np.concatenate([[0], np.cumsum(np.exp(gap))])


def _digest() -> Column:
    return F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def distinct_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each distinct text with a label, ``digest, label, doc_id, rows``.

    ``label`` is the mean over the ids that have the text, 1 from one half on; ``doc_id`` is the least of them and
    ``rows`` says how often it stands on that text.
    """
    few = known.limit(common.BROADCAST_IDS + 1).count() <= common.BROADCAST_IDS
    held = docs.select("doc_id", _digest().alias("digest")).join(F.broadcast(known) if few else known, "doc_id")
    held = held.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("label").alias("label"))
    held = held.groupBy("digest").agg(
        (F.avg("label") >= 0.5).cast("int").alias("label"), F.min(F.struct("doc_id", "rows")).alias("least")
    )
    return common.written(held.select("digest", "label", "least.doc_id", "least.rows"), "labelled-texts")


def _texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``text, label`` of each row of ``chosen`` once, though rows of ``docs`` may repeat."""
    few = chosen.limit(common.BROADCAST_IDS + 1).count() <= common.BROADCAST_IDS
    rows = docs.select("doc_id", "text", _digest().alias("digest"))

    def found(part: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(part) if few else part, ["doc_id", "digest"])

    single = found(chosen.where("rows = 1")).select("text", "label")
    several = chosen.where("rows > 1")
    if several.limit(1).count() == 0:
        return single
    return single.union(found(several).dropDuplicates(["doc_id", "digest"]).select("text", "label"))


def fit(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """The model of all rows that may be learned from. Without toxic and clean labels nothing is toxic."""
    known = common.labelled(labels, "toxic").where(~common.held_out())
    chosen = distinct_texts(docs, known)
    texts = _texts_of(docs, chosen)
    words = {w: i for i, w in enumerate(telling_words(texts.select("text", "label")))}
    nothing = OrdinalModel({}, np.zeros(0), np.array([6.0, 7.0]))
    if not words:
        return nothing

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, "text"):
            rows = [features(t, words) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([",".join(f"{i}:{c}" for i, c in sorted(r.items())) for r in rows], pa.string()),
                    pa.array([sum(r.values()) for r in rows], pa.int64()),
                    batch.column(1),
                ],
                names=["features", "telling", "label"],
            )

    sample = texts
    if chosen.count() > SAMPLE:
        # Ids alone are put in order; the texts of the sample stay where they are.
        sample = _texts_of(docs, chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(SAMPLE))
    counted = sample.mapInArrow(count, "features string, telling bigint, label int")
    grade = F.when(F.col("label") == 0, 0).when(F.col("telling") >= SEVERE, 2).otherwise(1)
    # Equal rows, most of them without a telling word, are counted first; the driver gets the sample at most.
    rows = counted.groupBy("features", grade.alias("grade")).agg(F.count(F.lit(1)).alias("n")).collect()
    rows.sort()
    parsed = [{int(i): int(c) for i, c in (p.split(":") for p in r.features.split(",") if p)} for r in rows]
    grades, weight = np.array([r.grade for r in rows]), np.array([r.n for r in rows], dtype=float)
    weights, thresholds = fit_ordinal(sparse(parsed, len(words)), grades, weight)
    return OrdinalModel(words, weights, thresholds)


def toxicity_scores(docs: DataFrame, labels: DataFrame, text_stays: bool = False) -> DataFrame:
    """``docs`` (without its text unless ``text_stays``) with ``held_out, score, severity, grade, predicted`` added.

    ``severity`` is the expected grade from 0 to 2, ``score`` the probability of any grade above 0, ``grade`` the
    likeliest grade and ``predicted`` 1 where ``score`` is at least one half. Null, empty and very long texts are
    texts like any other. Labels are learned only where ``crc32(doc_id)`` mod 5 is not 0; repeated labels of an id
    count as their mean, and so do labels of equal texts, which are one text to learn from. Rows are scored one by one; names that are taken get ``_`` before.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    at = docs.columns.index("text")
    keep = [i for i in range(len(docs.columns)) if text_stays or i != at]
    names = [common.free_name(docs, n) for n in ("score", "severity", "grade", "predicted")]
    kinds = [T.DoubleType(), T.DoubleType(), T.IntegerType(), T.IntegerType()]
    fields = [docs.schema.fields[i] for i in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in common.sliced(batches, "text"):
            x = sparse([features(t, known.words) for t in batch.column(at).to_pylist()], len(known.words))
            above = known.above(x)
            chance = np.concatenate([1 - above[:, :1], above[:, :1] - above[:, 1:], above[:, 1:]], axis=1)
            added = [
                pa.array(above[:, 0]),
                pa.array(above.sum(axis=1)),
                pa.array(chance.argmax(axis=1).astype(np.int32)),
                pa.array((above[:, 0] >= THRESHOLD).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *added], names=[*(f.name for f in fields), *names])

    scored = docs.mapInArrow(run, T.StructType([*fields, *(T.StructField(n, k) for n, k in zip(names, kinds, strict=True))]))
    return scored.withColumn(common.free_name(docs, "held_out"), common.held_out())
