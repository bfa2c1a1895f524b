"""Judging URLs by rules kept in a sorted digest array (operator 6).

A rule is a host and a path beginning, written ``host/path``. The list is one file: a header of counts, the sorted
64-bit xxhash digests of the rules, the offsets of their strings and verdicts, and the strings. Spark hands the file
to every executor, whose Python workers map it into memory and share its pages. A URL asks for every host suffix of as
many labels as some rule has, with every path beginning of a length some rule has; all digests of a batch are probed by
one vectorised binary search, and a probe that lands is confirmed against the stored string, so a collision never
judges. What a URL asks for is bounded by the rules, however long its host and path are.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from . import common
from .token_files import _put

ALLOW, BLOCK = "allow", "block"
#: Rules of the query (fixed values): verdict, host, path beginning.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
#: Verdict where no rule of the array fits: the array lists what is known, anything else passes.
DEFAULT = ALLOW


def _digests(keys: Iterable[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)


def array_bytes(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The file's bytes. Of rules with one host and path the last given stands."""
    verdicts = {f"{host.lower()}{path}".encode("utf-8", "surrogatepass"): v for v, host, path in rules}
    keys = list(verdicts)
    digests = _digests(keys)
    order = np.argsort(digests, kind="stable")
    keys = [keys[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype("<i8")
    blocked = np.array([verdicts[k] == BLOCK for k in keys], dtype=np.uint8)
    paths = sorted({len(k.decode("utf-8", "surrogatepass").partition("/")[2]) + 1 for k in keys})
    labels = sorted({k.decode("utf-8", "surrogatepass").partition("/")[0].count(".") + 1 for k in keys})
    head = np.array([len(keys), len(paths), len(labels), *paths, *labels], dtype="<i8")
    return b"".join([head.tobytes(), digests[order].astype("<u8").tobytes(), offsets.tobytes(), b"".join(keys), blocked.tobytes()])


class DigestArray:
    """A mapped file of rules."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n, lengths, labels = (int(x) for x in raw[:24].view("<i8"))
        at = 24 + 8 * lengths
        self.lengths = raw[24:at].view("<i8").tolist()
        self.labels = raw[at : at + 8 * labels].view("<i8").tolist()
        at += 8 * labels
        self.digests = raw[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = raw[at : at + 8 * (n + 1)].view("<i8")
        at += 8 * (n + 1)
        self.strings = raw[at : at + int(self.offsets[-1])]
        self.blocked = raw[at + int(self.offsets[-1]) :]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Place of each key in the array, or -1."""
        digests = _digests(keys)
        at = np.searchsorted(self.digests, digests)
        out = np.full(len(keys), -1, dtype=np.int64)
        n = len(self.digests)
        for i in np.flatnonzero((at < n) & (self.digests[np.minimum(at, max(n - 1, 0))] == digests)) if n else ():
            place = int(at[i])
            while place < n and self.digests[place] == digests[i]:  # equal digests stand side by side
                if self.strings[self.offsets[place] : self.offsets[place + 1]].tobytes() == keys[i]:
                    out[i] = place
                    break
                place += 1
        return out


def _candidates(host: str, path: str, lengths: list[int], labels: list[int]) -> list[str]:
    """Rule strings that would fit, longest first; equally long ones in string order.

    ``lengths`` and ``labels`` are the path lengths and label counts that rules have, in rising order.
    """
    if not host or not labels or not path.startswith("/"):
        return []
    parts = host.rsplit(".", labels[-1])
    hosts = [".".join(parts[-k:]) for k in labels if k <= len(parts)]
    found = {h + path[:n] for h in hosts if h for n in lengths if n <= len(path)}
    return sorted(found, key=lambda k: (-len(k), k))


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """All columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (``_host`` where a name is taken).

    The host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path from there to
    ``?``, ``#`` or the end. A null URL, or one without ``://``, has both empty and no rule. A rule fits its host and
    all subdomains where the path begins with the rule's; the longest rule string wins. ``rule`` is null and the
    verdict ``default`` where none fits. Rows are judged one by one, repeated ones too; an empty table gives none.
    """
    spark = pages.sparkSession
    name = f"rules-{uuid.uuid4().hex}.bin"
    folder = f"{shared_dir(spark).rstrip('/')}/silverbrook"
    _put(folder, name, [array_bytes(rules)])
    spark.sparkContext.addFile(f"{folder}/{name}")
    names = [common.free_name(pages, n) for n in ("host", "path", "rule", "verdict")]
    lower = F.translate(F.col("url"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = pages.withColumns(
        {
            names[0]: F.coalesce(F.regexp_extract(lower, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")),
            names[1]: F.coalesce(F.regexp_extract("url", r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    )
    at = len(pages.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(os.path.join(SparkFiles.getRootDirectory(), name))
        for batch in batches:
            asked, owner = [], []
            for i, (host, path) in enumerate(zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist(), strict=True)):
                keys = _candidates(host, path, array.lengths, array.labels)
                asked += [k.encode("utf-8", "surrogatepass") for k in keys]
                owner += [i] * len(keys)
            places = array.find(asked)
            rule, verdict = [None] * batch.num_rows, [default] * batch.num_rows
            for k in np.flatnonzero(places >= 0)[::-1]:  # backwards: a row's longest rule is set last
                rule[owner[k]] = asked[k].decode("utf-8", "surrogatepass")
                verdict[owner[k]] = BLOCK if array.blocked[places[k]] else ALLOW
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=[*batch.schema.names, *names[2:]],
            )

    text = [T.StructField(n, T.StringType()) for n in names[2:]]
    return split.mapInArrow(run, T.StructType([*split.schema.fields, *text]))
