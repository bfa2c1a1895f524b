"""Finding benchmark passages in documents with an FM-index per shard (operator 7).

A shard is a slice of an Arrow batch. Words the benchmark does not have cannot take part in a match, so a shard's
stream keeps only runs of benchmark words long enough for the shortest window, parted by symbol 0. Over the stream
stand a suffix array, its Burrows-Wheeler transform in a wavelet tree of bit planes, and every ``SAMPLE``-th suffix
position. All windows search backward together, one symbol of each at a time; matches step back through the
transform to a sampled position, and overlapping spans merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 13
#: A document is contaminated when its hit words are at least one of so many.
SHARE = 20
SAMPLE = 8
#: Benchmark words held by one task at a time; a larger benchmark is searched in as many rounds as it needs.
ROUND_WORDS = 2_000_000


class FMIndex:
    """Backward search and location in a stream of small integers; 0 parts runs and is never searched.

    Inside, symbols are one larger, so that a unique least symbol ends the text.
    """

    def __init__(self, stream: np.ndarray, symbols: int):
        text = np.concatenate([stream.astype(np.int64) + 1, [0]])
        n = self.n = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        step = 1
        while True:
            after = np.zeros(n, dtype=np.int64)
            after[: n - step] = rank[step:] + 1
            key = rank * (n + 1) + after
            order = np.argsort(key, kind="stable")
            fresh = np.empty(n, dtype=np.int64)
            fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = fresh
            if rank[order[-1]] == n - 1 or step >= n:
                break
            step *= 2
        last = text[order - 1]
        self.first = np.searchsorted(np.sort(text), np.arange(symbols + 3))
        # Wavelet tree as bit planes: each plane is sorted stably by the bits above it.
        self.planes, level = [], last
        for bit in range(max(1, int(symbols + 1).bit_length()) - 1, -1, -1):
            ones = level >> bit & 1
            self.planes.append((bit, np.concatenate([[0], np.cumsum(ones)])))
            level = np.concatenate([level[ones == 0], level[ones == 1]])
        self.last = last
        sampled = order % SAMPLE == 0
        self.rank_of_sample = np.concatenate([[0], np.cumsum(sampled)])
        self.sampled, self.samples = sampled, order[sampled]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each place."""
        low, high = np.zeros_like(place), place
        for bit, ones in self.planes:
            zeros = self.n - ones[-1]
            up = symbol >> bit & 1 == 1
            low = np.where(up, zeros + ones[low], low - ones[low])
            high = np.where(up, zeros + ones[high], high - ones[high])
        return high - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all phrases, rows of one length."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        for symbol in phrases.T[::-1] + 1:
            base = self.first[symbol]
            low, high = base + self.rank(symbol, low), base + self.rank(symbol, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Stream positions of suffixes, by stepping back to the nearest sampled one."""
        steps, place = np.zeros(len(rows), dtype=np.int64), rows.copy()
        open_ = np.flatnonzero(~self.sampled[place])
        while len(open_):
            symbol = self.last[place[open_]]
            place[open_] = self.first[symbol] + self.rank(symbol, place[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[place[open_]]]
        return self.samples[self.rank_of_sample[place]] + steps


class Phrases:
    """A round's windows as rows of word numbers, by length, with the item of each."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        rows: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            found = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in common.words(text)]
            width = min(window, len(found))
            for i in range(len(found) - width + 1 if width else 0):
                rows.setdefault(width, {}).setdefault(tuple(found[i : i + width]), set()).add(item)
        self.by_width = {
            width: (np.array(list(of), dtype=np.int64), [sorted(i, key=str) for i in of.values()])
            for width, of in rows.items()
        }
        self.shortest = min(self.by_width, default=1)


def find_spans(texts: list[str | None], phrases: Phrases) -> list[tuple[int, np.ndarray, list]]:
    """For each text: its word count, merged hit spans as an (k, 2) array of word places, and the items found."""
    number, shortest = phrases.numbers.get, phrases.shortest
    counts, runs, homes, starts = [], [], [], []
    for d, text in enumerate(texts):
        found = common.words(text) if text else []
        counts.append(len(found))
        if len(found) < shortest:
            continue
        ids = np.fromiter((number(w, 0) for w in found), dtype=np.int64, count=len(found))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]])))
        for low, high in zip(edges[::2], edges[1::2], strict=True):
            if high - low >= shortest:
                runs.append(ids[low:high])
                homes.append(d)
                starts.append(low)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    if runs:
        sizes = np.array([len(r) + 1 for r in runs])
        begins = np.cumsum(sizes) - sizes
        index = FMIndex(np.concatenate([x for r in runs for x in (r, [0])]), len(phrases.numbers))
        for width, (rows, owners) in phrases.by_width.items():
            low, high = index.search(rows)
            hit = np.flatnonzero(high > low)
            if not len(hit):
                continue
            many = high[hit] - low[hit]
            places = np.repeat(low[hit] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            positions = index.locate(places)
            run = np.searchsorted(begins, positions, "right") - 1
            for row, r, at in zip(np.repeat(hit, many), run, positions - begins[run], strict=True):
                spans[homes[r]].append((int(starts[r] + at), int(starts[r] + at + width)))
                items[homes[r]].update(owners[row])
    return [(n, _merged(s), sorted(i, key=str)) for n, s, i in zip(counts, spans, items, strict=True)]


def _merged(spans: list[tuple[int, int]]) -> np.ndarray:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def _rounds(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The benchmark's items in rounds of bounded size; rows stream to the driver one partition at a time."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        held.append((row.item_id, row.text))
        size += len(row.text) // 4 + 1
        if size > ROUND_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``spans``, ``n_hit`` and ``items`` added (names taken get ``_`` before).

    ``spans`` are merged ``[from, to)`` word places inside any occurrence of a window of a benchmark item: ``window``
    consecutive words, or all of a shorter item. A null or empty text has no words and no spans. Items without text or
    words match nothing; those without an id mark words like any other but are not listed; repeated items count once. Rows are judged one by one, so repeated rows and
    rows without an id are kept. Empty tables give no rows, or no spans.
    """
    names = [common.free_name(docs, n) for n in ("n_words", "spans", "items")]
    span = "array<struct<from: bigint, to: bigint>>"
    rounds = iter(_rounds(benchmark))
    out, first = docs, next(rounds, [])
    place = docs.columns.index("text")
    out = _one_round(out, first, window, names, place)
    # Further rounds of a benchmark beyond the bound look at the texts again and unite what they find.
    for i, some in enumerate(rounds):
        more = [f"{n}_round{i}" for n in names]
        out = _one_round(out, some, window, more, place)
        out = out.withColumn(names[1], F.concat(names[1], more[1])).withColumn(names[2], F.array_union(names[2], more[2]))
        out = out.drop(*more)
    hit = common.free_name(out, "n_hit")
    return out.withColumn(names[1], F.col(names[1]).cast(span)).withColumn(hit, _covered(F.col(names[1])))


def _covered(spans):
    """Words inside any of the spans, which may overlap between rounds."""
    step = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).cast("bigint").alias("end")),
        lambda s, x: F.struct(
            (s["sum"] + F.greatest(F.lit(0).cast("bigint"), x["to"] - F.greatest(x["from"], s["end"]))).alias("sum"),
            F.greatest(s["end"], x["to"]).alias("end"),
        ),
    )
    return step["sum"]


def _one_round(docs: DataFrame, items: list[tuple], window: int, names: list[str], place: int) -> DataFrame:
    phrases = docs.sparkSession.sparkContext.broadcast(Phrases(items, window))
    key = T.StructType(
        [
            T.StructField(names[0], T.LongType()),
            T.StructField(names[1], T.ArrayType(T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))),
            T.StructField(names[2], T.ArrayType(T.StringType())),
        ]
    )
    pair = pa.struct([("from", pa.int64()), ("to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, batch_text):
            found = find_spans(batch.column(place).to_pylist(), phrases.value)
            added = [
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[{"from": int(a), "to": int(b)} for a, b in s] for _, s, _ in found], pa.list_(pair)),
                pa.array([[str(i) for i in items if i is not None] for _, _, items in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    batch_text = docs.columns[place]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *key.fields]))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def digest_columns(judged: DataFrame) -> DataFrame:
    """The counted form: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
