"""Every operator on awkward rows, against plain re-computations."""

import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook.llm import (
    common,
    decontamination,
    html_text,
    jaccard_join,
    license_scan,
    neighbours,
    packing,
    quality,
    token_files,
    tokens,
    toxicity,
    url_filter,
)

from . import brute

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    # Columns that the operators would like to add themselves.
    + [T.StructField(n, T.StringType()) for n in ("score", "Predicted", "held_out", "n_words", "spans", "ids", "items")]
)
LABELS = "doc_id bigint, quality int, toxic int"
BENCHMARK = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
    (10, "short item here"),
    (2, "Short, ITEM here!"),
    (3, ""),
    (4, None),
    (None, "no id at all"),
]


def texts():
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    long = " ".join(draw.choice(vocabulary) for _ in range(60_000))
    base = [draw.choice(vocabulary) for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    rows = [
        None, "", " \t\n ", "one", "a b c", "a b c", "A  b\tC", long, long + " tail", " ".join(base), " ".join(near),
        "cc by cc-by all rights reserved", "GNU General Public License all RIGHTS, reserved", "£€ ünïcode 文字 🙂 e\u0301",
        "Released under the MIT License.\nnothing else", "x short item here y " * 3, BENCHMARK[0][1] + " z",
        "word " * 3000, "'s 't don't I'LL <|endoftext|> 12½", "\x00a\x01 \x85 b\xa0c \x1c d",
    ]
    return rows + [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 60))) for _ in range(120)]


ROWS = [(i, t) for i, t in enumerate(texts())]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 7) for i, t in rows], DOCS).repartition(4)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows and rows without an id."""
    return frame(spark, [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, None), (7, "a b c d e")])


def by_id(df, *columns):
    found = {r.doc_id: tuple(r[c] for c in columns) for r in df.select("doc_id", *columns).collect()}
    return found


# Operators 1 and 5: packing and token files.


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 5), min_size=1, max_size=12), st.integers(1, 64))
def test_least_slack_fills_windows_as_full_as_any_choice(counts, capacity):
    chosen = packing.least_slack(counts, capacity)
    fitting = [n for n in counts if n <= capacity]
    if not fitting:
        assert chosen == {}
        return
    assert all(0 < c <= counts[n] for n, c in chosen.items()) and max(fitting) in chosen
    sums = {max(fitting)}
    for n in fitting:
        for _ in range(counts[n] - (n == max(fitting))):
            sums |= {s + n for s in sums}
    assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= capacity)


def check_pieces(pieces, rows, capacity):
    ids = dict(zip([i for i, _ in rows], brute.encoded([t for _, t in rows]), strict=True))
    cover, sequences = {}, {}
    for p in pieces:
        whole = ids[p.doc_id]
        assert bytes(p.ids) == np.array(whole[p.start : p.start + p.length], dtype="<u4").tobytes()
        assert p.doc_tokens == len(whole) and 0 < p.length <= capacity
        cover.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for found, total in [(cover[i], len(whole)) for i, whole in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == total if total else at <= capacity
    return len(sequences), sum(map(len, ids.values()))


def test_packing_places_every_id_once_with_little_padding(docs):
    n, total = check_pieces(packing.pack_documents(docs).collect(), ROWS, 2048)
    assert n <= total / 2048 * 1.02 + 2
    n, total = check_pieces(packing.pack_documents(docs, capacity=64).collect(), ROWS, 64)
    assert n <= total / 64 * 1.02 + 2


def test_packing_keeps_repeated_rows_and_rows_without_id(odd, spark):
    pieces = packing.pack_documents(odd).collect()
    assert sorted((p.doc_id or 0) for p in pieces) == [0, 0, 5, 5, 7]
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_encoder_equals_the_tokenizer():
    draw = random.Random(3)
    letters = "aAbZ 'sT\n\té´ßÿ×9½\x85\xa0\u0301Σ中.*-_&;"
    some = ["".join(draw.choice(letters) for _ in range(40)) for _ in range(500)] + [t for _, t in ROWS]
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "<", "a", "Zé", " ", "endoftext", "\u0301", "9", "<|ENDOFTEXT|>"]
    some += ["".join(draw.choice(parts) for _ in range(12)) for _ in range(500)]
    some += ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "x<|startoftext|>.", "<|endoftext|"]
    encode = tokens.WordEncoder()
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(some)] == brute.encoded(some)


def test_a_call_encodes_a_distinct_word_once_however_little_is_remembered():
    encode, made = tokens.WordEncoder(), []
    for memory in [m for m in vars(encode).values() if isinstance(m, tokens._Memory)]:
        memory.limit, make = 0, memory.make
        memory.make = lambda key, make=make: made.append(key) or make(key)
    some = ["red, Red", "green \u4e2d", None, "", " blue<|endoftext|>"] * 40
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(some)] == brute.encoded(some)
    assert len(made) == len(set(made)) and encode([]) == []


def test_token_files_in_small_shards(docs, odd, spark, folder):
    for at, frame in enumerate((docs, odd, odd.unionByName(odd))):
        whole = token_files.write_token_files(frame, f"{folder}/w{at}")
        small = token_files.write_token_files(frame, f"{folder}/s{at}", shard_ids=10)
        rows = [
            sorted(token_files.read_token_files(spark, manifest, f"{folder}/{name}{at}").collect(), key=lambda r: r.start)
            for manifest, name in ((whole, "w"), (small, "s"))
        ]
        assert rows[0] == rows[1] and small.count() > whole.count()
        # Shards follow each other without a gap, and only one with a single long document passes the bound by much.
        end = 0
        for shard in sorted(small.collect(), key=lambda r: r.base):
            assert shard.base == end
            end += shard.ids
        assert end == sum(r.n_tokens for r in rows[0])


def test_token_files_round_trip(docs, odd, spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = token_files.write_token_files(docs, f"{folder}/a")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sorted(token_files.read_token_files(spark, manifest, f"{folder}/a").collect())
    at = 0
    for row, ids in zip(rows, brute.encoded([t for _, t in ROWS]), strict=True):
        assert (row.start, row.n_tokens, zlib.crc32(bytes(row.ids))) == (at, len(ids), brute.crc(ids))
        at += len(ids)
    bases = [r.base for r in sorted(manifest.collect())]
    assert bases == sorted(bases) and len(bases) > 1
    again = token_files.read_token_files(spark, token_files.write_token_files(odd, f"{folder}/b"), f"{folder}/b")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in again.collect()) == [(0, 1), (0, 6), (5, 6), (5, 6), (7, 6)]
    empty = token_files.write_token_files(odd.limit(0), f"{folder}/c")
    assert token_files.read_token_files(spark, empty, f"{folder}/c").count() == 0


# Operator 2: HTML.


def test_blocks_follow_markup():
    page = (
        '<body><header>H</header><div class="cookie-notice">c</div><div id=x>free <i>in</i>line<br>next</div>'
        '<main><header><h1>T</h1></header><p>a&nbsp;b &lt;x&gt; <a href=">">q</a><section class="comments"><p>no'
        "</section><p>yes<script>var t='</p>';</script></main>tail<footer>f"
    )
    assert html_text.blocks_of(page) == [
        (False, "free inline"), (False, "next"), (True, "T"), (True, "a b <x> q"), (True, "yes"), (False, "tail")
    ]
    assert html_text.blocks_of(None) == html_text.blocks_of("") == html_text.blocks_of("<p></p>") == []
    assert html_text.blocks_of("<!-- <p>x</p> -->a < b<!-- open") == [(False, "a < b")]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>x</title><body><article><p>text</p></article>", [(True, "text")]),
        ("<head><meta charset=x><title>x</title><p>text</p>", [(False, "text")]),
        ("<head><title>x</title>loose<p>text</p>", [(False, "loose"), (False, "text")]),
        ("<head-line>text</head-line>", [(False, "text")]),
        ('<svg width="1"/><p>rest</p>', [(False, "rest")]),
        ("<svg><text>x</text></svg><p>rest</p>", [(False, "rest")]),
        ("<article><iframe src=x><p>a</p><select><p>b</p><object><p>c</p></article>", [(True, "a"), (True, "b"), (True, "c")]),
        ("<select><option>a<p>b</p><select><option>x</select><p>c</p>", [(False, "a"), (False, "b"), (False, "c")]),
        ("<p>a</p><script>var t = 1; <p>no", [(False, "a")]),
        ('<div class="site has-sidebar"><article>text</article></div>', [(True, "text")]),
        ('<article class="no-comments"><p>text</p></article>', [(True, "text")]),
        ('<div class="sidebar"><article>text</article></div>', [(True, "text")]),
        ('<article>text<div class="comments-area"><article>no</article></div></article>', [(True, "text")]),
        ('<article>text</article><div class="related"><article>no</article></div>', [(True, "text")]),
        ('<article>a<div class="user-comments">no</div><p id="readerComment">no</p><p class="author-notice">no</p></article>', [(True, "a")]),
        ('<article class="has-comments">a<p class="commentary">b</p><p class="entry-without-ads">c</p></article>', [(True, "a"), (True, "b"), (True, "c")]),
        ('<article>a<section class="reader-comments"><article class="comment">no</article></section></article>', [(True, "a")]),
        ('<nav><article>no</article></nav><div class="site-header">no</div><ul class="comment-list"><li>no</ul>', []),
    ],
)
def test_markup_cuts_no_article(page, want):
    assert html_text.blocks_of(page) == want


@pytest.mark.parametrize(
    "shape",
    [
        lambda n: "<a " * 6 * n, lambda n: "<div>" * 2 * n + "</span>" * 2 * n, lambda n: "<span>" + "<div>" * 2 * n + "</span>" * 2 * n,
        lambda n: "<a '\"" * 4 * n, lambda n: "<a " * 6 * n + '">', lambda n: "<a" * 9 * n, lambda n: "<!" * 9 * n,
        lambda n: "<select>" + "<select " * 2 * n, lambda n: "<b>" * 2 * n + "<div></div>" * n, lambda n: "<!--" * 4 * n,
        lambda n: "<li><b>" * 2 * n, lambda n: "<p " + "class='x' " * 2 * n + ">", lambda n: "<div class=\"a'b\" id='c\"d'>" * n, lambda n: "&" * 20 * n,
    ],
)
def test_pages_of_any_shape_take_linear_time(shape):
    def seconds(page):
        began = time.process_time()
        html_text.blocks_of(page)
        return time.process_time() - began

    # Four times the page takes four times the time; a square would take sixteen times it.
    small, large = (min(seconds(shape(n)) for _ in range(3)) for n in (3_000, 12_000))
    assert large < 8 * small + 0.1
    assert large < 5


def covered_by_brute(streams, pages, run):
    windows = {}
    for s, p in zip(streams, pages, strict=True):
        for i in range(len(s) - run + 1):
            windows.setdefault(tuple(s[i : i + run]), set()).add(p)
    return [
        {j for i in range(len(s) - run + 1) if len(windows[tuple(s[i : i + run])]) > 1 for j in range(i, i + run)}
        for s in streams
    ]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.lists(st.integers(1, 3), min_size=1, max_size=12)), min_size=1, max_size=6), st.integers(1, 5))
def test_suffix_array_finds_repeated_runs(pages, run):
    streams = [np.array(s) for _, s in pages]
    owners = np.array([p for p, _ in pages])
    covered, _ = html_text.repeated_tokens(streams, owners, run)
    want = covered_by_brute([list(map(int, s)) for s in streams], owners.tolist(), run)
    assert [set(np.flatnonzero(c).tolist()) for c in covered] == want


@pytest.mark.parametrize("slice_tokens", [400_000, 8])
def test_boilerplate_of_a_host_goes_whatever_the_slices(spark, monkeypatch, slice_tokens):
    monkeypatch.setattr(html_text, "SLICE_TOKENS", slice_tokens)
    shared = "read all our other stories on this very site today"
    rows = [(i, f"http://a.example/{i}", f"<div>story {i} tells of item {i * i} alone</div><div>{shared}</div>") for i in range(12)]
    rows += [(90, "http://b.example/", f"<div>{shared}</div>"), (91, None, None), (92, "x", ""), (93, None, "<article>kept</article>")]
    rows += [(94, "http://a.example/94", f"<article><p>{shared}</article>")]
    rows += [(i, f"http://A.example/{i}", f"<div>Home</div><div>only {i}</div><div>go {shared} {i}</div>") for i in (95, 96)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string").repartition(3)
    got = {r.page_id: r._text for r in html_text.extract_text(pages).collect()}
    want = {i: f"story {i} tells of item {i * i} alone" for i in range(12)}
    assert got == want | {90: shared, 91: "", 92: "", 93: "kept", 94: shared, 95: "only 95 95", 96: "only 96 96"}
    assert html_text.extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("slice_tokens", [150, 60])
def test_runs_on_several_pages_of_a_slice_cover_those_of_other_slices(spark, monkeypatch, slice_tokens):
    # Each run stands on three or four pages, so slices hold 2+1, 3+1 and 2+2 of them.
    runs = [" ".join(f"run{k}w{j}" for j in range(7)) for k in range(8)]
    blocks = {i: [runs[k] for k in range(8) if (i * 5 + k * 3) % 12 < 3 + k % 2] for i in range(12)}
    assert {sum(r in b for b in blocks.values()) for r in runs} == {3, 4}
    rows = [
        (i, "http://a.example/", "".join(f"<div>{b}</div>" for b in [f"own{i} is the text of page{i} and no other", *found]))
        for i, found in blocks.items()
    ]
    monkeypatch.setattr(html_text, "SLICE_TOKENS", slice_tokens)
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    assert got == {i: f"own{i} is the text of page{i} and no other" for i in range(12)}


def test_copies_and_shared_phrases_keep_their_text(spark):
    quoted = "to be or not to be that is"
    rows = [(i, "http://copies.example/", "<div>one text that many rows of this host repeat</div><p>Home") for i in range(20)]
    rows += [(20, "http://two.example/", f"<p>first page says {quoted}"), (21, "http://two.example/", f"<p>second has {quoted}")]
    own = {i: f"page{i} alone tells of thing{i}" for i in range(30, 60)}
    shared = "all pages of this host have this line"
    rows += [(i, "http://big.example/", f"<div>{shared}</div><p>{o}" + (f"<p>{quoted}" if i < 33 else "")) for i, o in own.items()]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    found = html_text.extract_text(pages)
    assert found.columns == ["page_id", "url", "text"]
    got = {r.page_id: r.text for r in found.collect()}
    assert got == (
        {i: "one text that many rows of this host repeat Home" for i in range(20)}
        | {20: f"first page says {quoted}", 21: f"second has {quoted}"}
        | {i: o + (f" {quoted}" if i < 33 else "") for i, o in own.items()}
    )


@pytest.mark.parametrize("slice_tokens", [400_000, 60, 8])
def test_whole_pages_are_searched_for_what_undecided_blocks_repeat(spark, monkeypatch, slice_tokens):
    monkeypatch.setattr(html_text, "SLICE_TOKENS", slice_tokens)
    menu, teaser = "front page world sport weather and all the rest", "the mayor opened a bridge over the old river"
    own = {i: f"page{i} alone tells of thing{i} and of place{i}" for i in range(12)}
    rows = [(i, "http://a.example/", f"<nav>{menu}</nav><article><p>{own[i]}<p>{teaser}</article>") for i in range(10)]
    # Two pages of the host leave to the suffix array what the others name; each has a text of its own.
    rows += [(10, "http://A.example/", f"<div>{menu}</div><div>{own[10]}</div>"), (11, "http://a.example/", f"<p>{teaser}<p>{own[11]}")]
    rows += [(12, "http://b.example/", f"<div>{menu}</div><div>{teaser}</div>"), (13, "http://b.example/", f"<nav>{menu}</nav>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    want = {i: f"{own[i]} {teaser}" for i in range(10)} | {10: own[10], 11: own[11], 12: f"{menu} {teaser}", 13: ""}
    assert got == want


# Operators 3 and 9: classifiers.


def labelled_rows():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(20, 80))]
        good, toxic = i % 3 != 0, i % 4 == 0
        if not good:
            words = [w + draw.choice(["***", "###", "$$$"]) for w in words]
        if toxic:
            for _ in range(draw.randint(1, 6)):
                words[draw.randrange(len(words))] = draw.choice(["vilething", "nastyword"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.mark.parametrize("which", ["quality", "toxic"])
def test_classifiers_tell_held_out_rows_apart(spark, which):
    rows, labels = labelled_rows()
    rows += [(1000, None), (1001, ""), (1002, "long " * 50_000), (None, "x")]
    docs, known = frame(spark, rows), spark.createDataFrame(labels + labels[:5], LABELS)
    if which == "quality":
        found, score, flag, held = quality.quality_scores(docs, known), "_score", "_predicted", "_held_out"
    else:
        found, score, flag, held = toxicity.toxicity_scores(docs, known), "_score", "_predicted", "_held_out"
    found = found.collect()
    assert len(found) == len(rows) and all(0 <= r[score] <= 1 for r in found)
    truth = {i: (q if which == "quality" else t) for i, q, t in labels}
    out = [(r[score], r[flag], truth[r.doc_id]) for r in found if r.doc_id in truth and r[held]]
    assert {r[held] == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None} == {True}
    assert brute.auc([o[0] for o in out], [o[2] for o in out]) > 0.97
    assert np.mean([o[1] == o[2] for o in out]) > 0.95


@pytest.mark.parametrize("operator", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_without_labels_or_rows(spark, odd, operator):
    none = spark.createDataFrame([(None, 1, 1), (5, None, None)], LABELS)
    found = operator(odd, none).collect()
    assert len(found) == 5 and len({r._score for r in found}) == 1
    assert operator(odd.limit(0), none).count() == 0


def test_learning_ignores_held_out_labels(spark):
    rows, labels = labelled_rows()
    docs = frame(spark, rows)
    turned = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    for operator in (quality.quality_scores, toxicity.toxicity_scores):
        a, b = (by_id(operator(docs, spark.createDataFrame(x, LABELS)), "_score") for x in (labels, turned))
        assert all(abs(a[i][0] - b[i][0]) < 1e-9 for i in a)


def test_ordinal_thresholds_stay_ordered_and_share_weights():
    draw = np.random.default_rng(0)
    x = draw.poisson(0.7, (400, 3)).astype(float)
    grades = np.clip((x.sum(axis=1) > 1).astype(int) + (x.sum(axis=1) > 3), 0, 2)
    w, t = toxicity.fit_ordinal(x, grades, np.ones(400))
    assert t[0] < t[1] and (w > 0).all()
    severity = toxicity.OrdinalModel({}, w, t).above(x).sum(axis=1)
    assert np.corrcoef(severity, grades)[0, 1] > 0.8


def test_copies_of_a_toxic_text_displace_no_telling_word(spark):
    rows, labels = labelled_rows()
    long = " ".join(f"own{k}" for k in range(400))
    copies = [(i, long) for i in range(2000, 2300)]
    docs = frame(spark, rows + copies + copies[:9] * 3)
    known = spark.createDataFrame(labels + [(i, 1, 1) for i, _ in copies], LABELS)
    assert set(toxicity.fit(docs, known).words) == {b"vilething", b"nastyword"}
    truth = {i: t for i, _, t in labels}
    found = by_id(toxicity.toxicity_scores(docs, known), "_predicted")
    assert np.mean([found[i][0] == t for i, t in truth.items()]) > 0.95


def test_every_word_with_evidence_is_a_feature(spark):
    telling = [f"vile{k}" for k in range(300)]
    rows = [(i, f"plain text {i} " + (" ".join(telling) if i % 2 else "")) for i in range(100)]
    known = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], LABELS)
    assert set(toxicity.fit(frame(spark, rows), known).words) == {w.encode() for w in telling}


# Operator 4: Jaccard join.


def near_rows():
    """Chains and crowds of near copies, exact copies, and unrelated texts that share a line."""
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(900)]
    line = " ".join(draw.choice(vocabulary) for _ in range(12))
    rows = []
    for _ in range(6):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(20, 90))]
        for _ in range(40):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 40))) + " " + line for _ in range(80)]
    rows += ["a b c", "A b  c", "", None, "one", "one"]
    return list(enumerate(rows))


@pytest.mark.parametrize(("shingles", "sets"), [(400_000, 8_000), (300, 7)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, shingles, sets):
    monkeypatch.setattr(jaccard_join, "SLICE_SHINGLES", shingles)
    monkeypatch.setattr(jaccard_join, "SLICE_SETS", sets)
    rows = near_rows()
    got = by_id(jaccard_join.jaccard_components(frame(spark, rows)), "n_shingles", "component_id", "n_links")
    assert got == brute.jaccard(rows)


def test_jaccard_join_on_awkward_rows(docs, odd):
    got = by_id(jaccard_join.jaccard_components(docs), "n_shingles", "component_id", "n_links")
    assert got == brute.jaccard(ROWS)
    rows = jaccard_join.jaccard_components(odd).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (0, 0), (5, 5), (5, 5), (7, 5)]
    assert jaccard_join.jaccard_components(odd.limit(0)).count() == 0


def test_repeated_rows_and_shared_ids_link_as_their_texts_do(spark):
    """Far neighbours of repeated rows, one id on linked and on unrelated texts; checked row by row."""
    a = [f"a{i}" for i in range(100)]
    far, near = a[:91] + [f"z{i}" for i in range(9)], a[:99] + ["z"]
    other, other_near = [f"y{i}" for i in range(60)], [f"y{i}" for i in range(59)] + ["q"]
    third = [f"x{i}" for i in range(50)]
    texts = {k: " ".join(v) for k, v in dict(a=a, far=far, near=near, other=other, other_near=other_near, third=third).items()}
    rows = [
        (1, "a"), (1, "a"), (2, "far"), (3, "a"), (7, "a"), (7, "other"), (9, "other_near"), (9, "other_near"), (4, "third"),
        (4, "near"), (5, "third"), (7, "other"), (11, None), (11, "far"), (12, None), (12, None), (None, "a"), (None, "a"),
    ]
    rows = [(i, texts.get(name)) for i, name in rows] + list(enumerate((texts["far"],) * 30, 100))
    found = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    known = [(at, i, t) for at, (i, t) in enumerate(rows) if i is not None]
    plain = brute.jaccard([(at, t) for at, _, t in known])
    least = {}
    for at, i, _ in known:
        least[plain[at][1]] = min(i, least.get(plain[at][1], i))
    want = [(i, plain[at][0], least[plain[at][1]], plain[at][2]) for at, i, _ in known]
    want += [(None, plain[0][0], None, 0)] * 2
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_near_duplicates_go_for_their_texts_and_not_for_their_ids(spark):
    a, b = [f"a{i}" for i in range(80)], [f"b{i}" for i in range(80)]
    near = a[:79] + ["n"]
    rows = [
        (1, a), (1, a), (2, near), (3, b), (3, a), (5, b), (6, ["c"] * 9), (6, ["d"] * 9), (6, ["c"] * 9), (8, []), (8, []), (8, near),
        (None, a), (None, a), (4, [f"e{i}" for i in range(30)]), (10, [f"f{i}" for i in range(30)]), (10, [f"f{i}" for i in range(30)]),
    ]
    docs = frame(spark, [(i, " ".join(w)) for i, w in rows])
    kept = jaccard_join.without_near_duplicates(docs, size=5, percent=80)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text[:2]) for r in kept.collect())
    assert got == [
        (False, 1, "a0"), (False, 3, "b0"), (False, 4, "e0"), (False, 6, "c "), (False, 6, "d "), (False, 8, ""), (False, 8, ""),
        (False, 10, "f0"), (True, 0, "a0"), (True, 0, "a0"),
    ]
    assert jaccard_join.without_near_duplicates(docs.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1), min_size=1, max_size=12))
def test_t_occurrence_search_finds_all_partners(sets):
    index = [np.array(sorted(s)) for s in sets]
    n = np.array([len(s) for s in sets])
    lists = jaccard_join.inverted(index)
    for i, s in enumerate(sets):
        want = [j for j, t in enumerate(sets) if 100 * len(s & t) >= 85 * len(s | t)]
        assert jaccard_join.linked([], n, index[i], len(s), 85, lists).tolist() == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_components_equal_a_walk(spark, edges):
    found = dict(tuple(r) for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint"), "walk").collect())
    label = {i: i for e in edges if e[0] != e[1] for i in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label


# Operator 6: URLs.


@settings(max_examples=100, deadline=None)
@given(st.text("aA./:?#e1", max_size=20))
def test_url_candidates_hold_every_rule_that_fits(tail):
    rules = [("allow", "a", "/"), ("block", "e.a", "/e"), ("block", "a", "/1")]
    host, path, rule, _ = brute.url_verdict(f"x://{tail}", rules)
    lengths = sorted({len(p) for _, _, p in rules})
    labels = sorted({h.count(".") + 1 for _, h, _ in rules})
    fitting = [k for k in url_filter._candidates(host, path, lengths, labels) if k in {h + p for _, h, p in rules}]
    assert (fitting[0] if fitting else None) == rule


def test_long_hosts_and_paths_ask_for_no_more_than_short_ones(spark):
    host, path = "a." * 100_000 + "example.org", "/en/1" + "x" * 100_000
    began = time.perf_counter()
    for _ in range(10):
        asked = url_filter._candidates(host, path, [1, 4, 5], [1, 2])
    assert time.perf_counter() - began < 0.1
    assert asked == sorted(
        {h + path[:n] for h in ("org", "example.org") for n in (1, 4, 5)}, key=lambda k: (-len(k), k)
    )
    pages = spark.createDataFrame([(1, f"http://{host}{path}"), (2, "http://" + "x." * 50_000 + "net/")], "page_id int, url string")
    assert dict(url_filter.judge(pages).select("page_id", "rule").collect()) == {1: "example.org/en/1", 2: None}


def test_url_judgements(spark, monkeypatch):
    urls = [
        None, "", "no host", "http://", "HTTP://WWW.Example.ORG/es/x?y", "http://example.org/es", "http://example.org/en/1",
        "http://notexample.org/es/1", "https://a.b.com/fr/#x", "ftp://com/de/", "http://x.com?/de/", "a://b://c.org/",
        "http://x.com/de/\nnext", "http://example.org/en/12", "http://org", "http://.org/",
    ]
    rows = [(i, u, "taken") for i, u in enumerate(urls)] + [(4, urls[4], "taken"), (None, urls[4], "taken")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = url_filter.judge(pages)
    assert [tuple(r)[3:] for r in sorted(got.collect(), key=lambda r: (r.page_id is None, r.page_id or 0))] == [
        brute.url_verdict(u, url_filter.RULES) for _, u, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    ]
    assert url_filter.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules=()).collect()} == {"allow"}


def test_equal_digests_are_confirmed_by_their_strings(folder, monkeypatch):
    monkeypatch.setattr(url_filter, "_digests", lambda keys: np.array([7 for _ in keys], dtype=np.uint64))
    with open(f"{folder}/rules", "wb") as out:
        out.write(url_filter.array_bytes([("block", "a.org", "/"), ("allow", "b.org", "/x"), ("block", "c.org", "/")]))
    array = url_filter.DigestArray(f"{folder}/rules")
    found = array.find([b"b.org/x", b"z.org/", b"c.org/"])
    assert found[1] == -1 and array.blocked[found[0]] == 0 and array.blocked[found[2]] == 1


# Operator 7: decontamination.


def test_decontamination_equals_brute_force(docs, odd, spark):
    items = spark.createDataFrame(BENCHMARK, "item_id bigint, text string")
    wanted = brute.contaminated(ROWS, [b for b in BENCHMARK if b[1] is not None])
    judged = decontamination.contamination(docs.drop("n_words", "items"), items)
    assert by_id(decontamination.digest_columns(judged), "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == wanted
    assert any(w[4] for w in wanted.values())
    # An item without an id marks words but has no name to list.
    rows = spark.createDataFrame([(1, "x No ID, at all! y")], "doc_id bigint, text string")
    nameless = decontamination.contamination(rows, items)
    assert [tuple(r) for r in decontamination.digest_columns(nameless).select("n_hit", "n_items").collect()] == [(4, 0)]
    taken = decontamination.contamination(odd, items)
    assert taken.count() == 5 and {"_n_words", "_items", "_spans", "n_hit"} <= set(taken.columns)
    assert decontamination.contamination(odd.limit(0), items).count() == 0
    nothing = decontamination.contamination(docs, items.limit(0))
    assert nothing.where("n_hit > 0").count() == 0


def test_benchmark_beyond_the_bound_is_searched_in_rounds(docs, spark, monkeypatch):
    items = spark.createDataFrame(BENCHMARK, "item_id bigint, text string")
    plain = docs.drop("n_words", "items", "spans")
    once = by_id(decontamination.digest_columns(decontamination.contamination(plain, items)), "n_hit", "items_sha256")
    monkeypatch.setattr(decontamination, "ROUND_WORDS", 1)
    assert by_id(decontamination.digest_columns(decontamination.contamination(plain, items)), "n_hit", "items_sha256") == once


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_fm_index_counts_and_locates(stream, phrase):
    index = decontamination.FMIndex(np.array(stream), 3)
    low, high = index.search(np.array([phrase]))
    want = [i for i in range(len(stream)) if stream[i : i + len(phrase)] == phrase]
    assert sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist()) == want


# Operator 8: licences.


def test_license_scan(docs, odd):
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    for i, text in ROWS:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.base_license(text)
        labels, best = set(filter(None, r.base_labels.split(","))), 1.0 if r.n_base else 0.0
        for label, template in license_scan.TEMPLATES:
            wanted = set(template.split())
            for block in brute.sentences(text):
                share = len(wanted & set(brute.words(block))) / len(wanted)
                if share >= license_scan.CONTAINMENT - 1e-9:
                    labels.add(label)
                    best = max(best, share)
        assert (r.labels, round(r.score, 9)) == (",".join(sorted(labels)), round(best, 9))
    assert got[14].labels == "mit" and license_scan.scan_licenses(odd).count() == 5
    assert license_scan.scan_licenses(odd.limit(0)).count() == 0


def test_wrapped_notices_are_found(spark):
    bsd = (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
        " the following\nconditions are met:"
    )
    mit = "Permission is hereby granted, free of\ncharge, to any person obtaining\na copy of this software and"
    rows = [(0, bsd), (1, mit), (2, mit.replace("\n", "\r\n")), (3, "/*\n * " + bsd.replace("\n", "\n * ") + "\n */")]
    rows += [(4, mit.replace("free of\n", "free of\n\n").replace("\na copy", "\n *\n a copy")), (5, bsd.replace(" ", "\n"))]
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(frame(spark, rows)).collect()}
    assert got == {0: "bsd", 1: "mit", 2: "mit", 3: "bsd", 4: "", 5: "bsd"}


def test_the_statement_of_the_license_scan_judges_paragraphs_as_well(spark):
    import duckdb
    import pandas as pd

    from silverbrook.llm import queries

    wrapped = "Redistribution and use in source and\nbinary forms, with or without\nmodification, are permitted provided that\nthe following conditions are met"
    texts = [wrapped, wrapped.replace("\n", "\r\n"), wrapped.replace("without\n", "without\n *\n"), "released under\nthe mit license. x", None, ""]
    texts += [wrapped.replace("forms,", "forms."), "all rights\n\nreserved", "All rights reserved\x01 released under the MIT\rlicense"]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    connection = duckdb.connect()
    connection.register("documents", documents)
    want = connection.execute(queries.ORACLES["op8_license_scan"]).df()
    found = license_scan.scan_licenses(frame(spark, list(enumerate(texts)))).toPandas()
    assert len(documents) == len(found)
    for name in ("labels", "base_labels", "n_base", "score"):
        assert dict(zip(want.doc_id, want[name], strict=True)) == dict(zip(found.doc_id, found[name], strict=True))


# Operator 10: neighbours.


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_hilbert_keys_walk_from_cell_to_neighbour(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
    keys = neighbours.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(keys)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize(("block", "asked"), [(32_768, 2_048), (16, 2)])
def test_neighbours_with_whole_windows_equal_brute_force(spark, monkeypatch, block, asked):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "ASKED", asked)
    draw = np.random.default_rng(1)
    rows = [(int(i), draw.standard_normal(8).round(3).tolist()) for i in range(150)]
    rows += [(int(i), [1.0] * 8) for i in range(200, 260)]
    rows += [(300, None), (301, [0.0] * 8), (302, [None] * 8), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (305, [1.0]), (None, [1.0] * 8)]
    rows += [rows[0], rows[40]]
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, rank string, q int")
    wanted = brute.nearest([r for r in rows if r[0] != 305], every=10)
    found = {}
    for r in neighbours.search(vectors.repartition(4), query_every=10).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: [(v, round(s, 9)) for _, v, s in sorted(f)] for q, f in found.items()} == {
        q: [(v, round(s, 9)) for v, s in w] for q, w in wanted.items()
    }
    assert neighbours.search(vectors.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r)[:3] for r in neighbours.search(few).collect()] == [(0, 1, 1)]


def test_neighbours_reach_the_recall_asked_for(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    wanted = brute.nearest([(r.vec_id, r.embedding) for r in rows.collect()])
    # A floor under the least window, so that windows leave vectors out.
    found = neighbours.search(rows, least=0)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {v for v, _ in w}) for q, w in wanted.items())
    assert hits >= 0.9 * sum(len(w) for w in wanted.values())


def test_written_tables_lie_in_the_shared_folder(spark, odd):
    table = common.written(odd.select("doc_id"), "check")
    assert F.col and table.inputFiles()[0].split("/")[-3] == "silverbrook"
