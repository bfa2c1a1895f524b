"""Licence notices in documents by an exact containment join with templates (operator 8).

Everything is DataFrame functions. One pass over the texts splits words, places the base phrases and keeps, of the
few documents that hold enough of a template's words at all, the template words of each block (a sentence of a paragraph).
Template words are then ordered by their frequency over all documents, rarest first, and blocks meet templates by
prefix, length and position filters before the exact overlap is counted. Templates are a fixed short list, so they
are literals and the join needs no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Base phrases and their labels (fixed values).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices looked for as sets of words (fixed values).
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("gpl", "licensed under the gnu general public license version"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved"),
)
#: Least share of a template's distinct words that a block must hold.
CONTAINMENT = 0.8

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A line without a word ends a paragraph; a single line break, which may be a wrapped notice's, ends nothing.
_BLOCK_END = r"(?>\r\n|[\n\r])[\x00-\x09\x0B\x0C\x0E-\x2F\x3A-\x60\x7B-\x7F]*[\n\r]|[.!?;]\s+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _places(words: Column, phrase: str) -> Column:
    """Indexes where a phrase's words stand one after another; empty without its rarest word."""
    parts = phrase.split()
    last = F.size(words) - len(parts)

    def stands(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return found

    some = F.array_contains(words, parts[0]) & F.array_contains(words, parts[-1]) & (last >= 0)
    return F.when(some, F.filter(F.sequence(F.lit(0), last), stands)).otherwise(F.array().cast("array<int>"))


def _enough(containment: float, tokens: tuple[str, ...]) -> int:
    return math.ceil(round(containment * len(tokens), 9))


def scan_licenses(
    docs: DataFrame,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Words are lower-cased runs of letters, digits and characters beyond ASCII. ``n_base`` counts places of phrases,
    ``first_word`` and ``last_word`` are the least and largest of them, null without any. ``labels`` adds those of
    templates of which a block holds at least ``containment`` of the distinct words. ``score`` is 1 with a base
    phrase, else the best containment that counts, else 0. A null or empty text has no words, no labels and score 0.
    Rows are judged one by one, also with null or repeated ids; other columns are ignored.
    """
    sets = [(label, tuple(dict.fromkeys(text.split()))) for label, text in templates]
    vocabulary = sorted({word for _, tokens in sets for word in tokens})
    norm = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    words = F.split(F.col("norm"), _SEPARATOR)
    leading = (F.get("words", F.lit(0)) == "").cast("int")
    trailing = ((F.size("words") > 1) & (F.element_at("words", -1) == "")).cast("int")

    def labelled(places: Column, label: str) -> Column:
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    found = F.concat(*[labelled(_places(F.col("words"), p), label) for p, label in phrases])
    hopeful = F.lit(False)
    for _, tokens in sets:
        hopeful = hopeful | (F.size(F.array_intersect("held", _strings(tokens))) >= _enough(containment, tokens))
    blocks = F.transform(
        F.split("norm", _BLOCK_END),
        lambda b: F.array_intersect(F.split(b, _SEPARATOR), _strings(vocabulary)),
    )
    first = (
        docs.select("doc_id", norm.alias("norm"))
        .withColumn("words", words)
        .select(
            "doc_id",
            "norm",
            (F.size("words") - leading - trailing).cast("long").alias("n_words"),
            leading.cast("long").alias("lead"),
            found.alias("base"),
            F.array_intersect("words", _strings(vocabulary)).alias("held"),
        )
        .select(
            "doc_id", "n_words", "lead", "base", "held",
            F.when(hopeful, F.filter(blocks, lambda b: F.size(b) > 0)).otherwise(F.array().cast("array<array<string>>")).alias("blocks"),
        )
    )
    first = common.written(first, "license-blocks")
    # At most one row for each word of the templates.
    counts = {r.word: r.n for r in first.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    ranked = F.transform("blocks", lambda b: F.array_intersect(_strings(order), b))
    rows = first.withColumn("blocks", ranked)
    best = [_best_containment(F.col("blocks"), sorted(t, key=order.index), _enough(containment, t)) for _, t in sets]
    rows = rows.withColumn(
        "met", F.array(*[F.struct(F.lit(label).alias("label"), b.alias("share")) for (label, _), b in zip(sets, best, strict=True)])
    )
    base = F.array_distinct(F.col("base.label"))
    met = F.filter("met", lambda m: m["share"] > 0)
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        (F.array_min("base.at") - F.col("lead")).alias("first_word"),
        (F.array_max("base.at") - F.col("lead")).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform(met, lambda m: m["label"]))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.transform(met, lambda m: m["share"])), F.lit(0.0)))
        .alias("score"),
    )


def _best_containment(blocks: Column, tokens: list[str], enough: int) -> Column:
    """Largest share of a template a block holds, if that is enough; else 0. Words are in global order everywhere."""
    prefix, whole = _strings(tokens[: len(tokens) - enough + 1]), _strings(tokens)

    def passes(b: Column) -> Column:
        meeting = F.element_at(F.array_intersect(prefix, b), 1)
        bound = F.least(
            F.lit(len(tokens)) - F.array_position(whole, meeting) + 1, F.size(b) - F.array_position(b, meeting) + 1
        )
        return (F.size(b) >= enough) & F.arrays_overlap(b, prefix) & (bound >= enough)

    shares = F.transform(
        F.filter(blocks, passes),
        lambda b: F.size(F.array_intersect(b, whole)),
    )
    most = F.coalesce(F.array_max(shares), F.lit(0))
    return F.when(most >= enough, most / F.lit(float(len(tokens)))).otherwise(F.lit(0.0))
