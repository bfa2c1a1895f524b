"""Secrets in texts: keywords by automaton, anchored patterns near hits, checksums (operator 12).

One Aho-Corasick pass over the lower-cased text finds every place where a secret can begin. Only there is the kind's
pattern tried, anchored at the hit, so a text without keywords costs one linear pass. Runs of hex digits have no
keyword of their own: every four hex digits are one, since a run of 24 begins with four of them. Kinds that carry a
checksum inside the token are kept only where it agrees.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Kinds the contract names, then those this method adds; ties of spans are listed in this order.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("github", "npm")
KINDS = (*BASE_KINDS, *ADDED_KINDS)

# What the kinds begin with, lower-cased. No keyword of a kind lies inside another one of it, so hits in
# order of their ends are in order of their starts.
ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = "akia"
GITHUB = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
NPM = "npm_"
HEX_DIGITS = "0123456789abcdef"
#: Digits of the checksum at the end of a token: CRC-32 of the 30 characters before, in base 62.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TOKEN_BODY, TOKEN_CHECK = 30, 6

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_PATTERNS = {
    "assign": ASSIGN,
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]+)"),
    "npm": re.compile(r"npm_([0-9A-Za-z]+)"),
}


def base62(number: int, width: int = TOKEN_CHECK) -> str:
    digits = ""
    for _ in range(width):
        number, digit = divmod(number, 62)
        digits = BASE62[digit] + digits
    return digits


def checksum_agrees(token: str) -> bool:
    """Whether the last six characters of a token without prefix are the checksum of the thirty before them."""
    if len(token) != TOKEN_BODY + TOKEN_CHECK:
        return False
    return base62(zlib.crc32(token[:TOKEN_BODY].encode())) == token[TOKEN_BODY:]


_ACCEPTED = {
    "assign": lambda m: len(m[2]) >= 6,
    "access": lambda m: len(m[0]) >= 20,
    "hex": lambda m: len(m[0]) >= 24,
    "github": lambda m: checksum_agrees(m[1]),
    "npm": lambda m: checksum_agrees(m[1]),
}


@lru_cache(maxsize=1)
def automaton():
    """All keywords with kind and length; some 70,000 states, 3 MB, built once a worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    named = [(w, "assign") for w in ASSIGNED] + [(w, "github") for w in GITHUB] + [(ACCESS, "access"), (NPM, "npm")]
    four = (("".join(digits), "hex") for digits in itertools.product(HEX_DIGITS, repeat=4))
    for word, kind in itertools.chain(named, four):
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def spans_of(text: str | None) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of all secrets by start, then kind; code points, end exclusive.

    Per kind, matches are leftmost and do not overlap; one that fails the kind's test is dropped but still covers its
    characters. A hit inside an earlier match of its kind is passed over, so each character is matched once a kind.
    """
    if not text:
        return []
    # Bytes lower only A-Z, so places stay those of the text.
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    covered, found = dict.fromkeys(KINDS, 0), []
    for last, (kind, length) in automaton().iter(lowered):
        start = last + 1 - length
        if start < covered[kind]:
            continue
        match = _PATTERNS[kind].match(text, start)
        if match:
            covered[kind] = match.end()
            if _ACCEPTED[kind](match):
                found.append((start, KINDS.index(kind), match.end()))
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """The rows of ``docs`` with their secrets in ``into``: ``kind, start, end``, by start, then kind.

    Every row is judged by itself: repeated rows and ids stay, a null or empty text has no secret, texts of any length
    are read whole in time linear in their length, an empty table gives no rows. A column of ``docs`` that is already
    named ``into``, in any case, is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != into.lower()]
    names = [f"c{i}" for i in range(len(kept))]
    at = next(i for i, c in enumerate(kept) if c.lower() == text.lower())
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, names[at]):
            rows = [
                [{"kind": kind, "start": start, "end": end} for start, kind, end in spans_of(t)]
                for t in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _SPANS)], names=[*names, "spans"])

    kinds = ", ".join(f"{n} {kind}" for n, kind in plain.dtypes)
    found = plain.mapInArrow(judged, f"{kinds}, spans {SPANS_TYPE}")
    return found.select(*[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], F.col("spans").alias(into))


def _joined(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", one)


def digest_columns(found: DataFrame, spans: str = "secrets") -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of base spans and all spans as one string."""
    every = F.col(spans)
    of = lambda kind: F.size(F.filter(every, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(every, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
    )


def masked(text: str | None, spans: list[tuple[int, str, int]], mask: str = "[{}]") -> str | None:
    """``text`` with every secret replaced by its kind; overlapping spans become one, named by the first."""
    if not spans:
        return text
    merged: list[list] = []
    for start, kind, end in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    out, at = [], 0
    for start, kind, end in merged:
        out += [text[at:start], mask.format(kind)]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by its kind in brackets; null stays null."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = next(i for i, c in enumerate(docs.columns) if c.lower() == text.lower())
    plain = docs.toDF(*names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, names[at]):
            new = [masked(t, spans_of(t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, names[at], pa.array(new, pa.string()))

    return plain.mapInArrow(cut, plain.schema).toDF(*docs.columns)
