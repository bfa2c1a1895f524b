"""Main text of web pages with a suffix array per host (operator 2).

A page is read into blocks in page order. Markup tells three kinds apart: blocks inside the page's content container
(``article``, ``main``) are its text; blocks of navigation, headers, footers, asides, forms, adverts, notices, comments
and the like never are; all others are undecided. Over the token streams of all pages of a host, with blocks of every
kind, stands a suffix array: a token of an undecided block that is covered by a run of ``RUN`` tokens that enough pages of
the host have is boilerplate and goes, as does a shorter block that they repeat whole; all other runs stay. So a menu that
most pages mark as one is known on the page that doesn't. Enough is one in ``SHARE`` of the host's distinct pages, or of
those with undecided blocks where these alone are looked at, and two at least; of fewer than ``SHARE`` distinct pages,
where one in so many is no page, three. Pages with equal text are one page: copies are no evidence for each other.

A host's streams are cut into slices of bounded size by a hash of the page, each with its own suffix array. Pages of a
host that enough of them have are, of one slice at least, as many as its even share: runs as frequent as that in any
slice are counted in all of them, so the cut changes no result and little but these runs' digests leaves a slice.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

RUN, SHARE = 6, 8
SLICE_TOKENS = 400_000
#: Kinds of blocks.
UNDECIDED, ARTICLE, CHROME_TEXT = 0, 1, 2

# A tag ends at the first ``>`` outside quotes; possessive, so a failed match costs one look at what follows.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
_BEGINS_TAG = re.compile(r"</?[a-zA-Z]")
_NAME_ENDS, _QUOTES = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Fixed values of HTML: elements by what they do to text.
#: Elements skipped with all they hold. The first two have no end but their own; others without an end are plain tags.
RAW = frozenset("script style noscript template textarea select svg math iframe object title".split())
ENDLESS, NEVER_NESTED = frozenset("script style".split()), frozenset("select iframe noscript".split())
#: What may stand in a head; any other element, or text, ends it.
HEAD = frozenset("head base basefont bgsound link meta title script style noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img".split()
)
CONTENT = frozenset("article main".split())
CHROME = frozenset("nav header footer aside form menu dialog button fieldset".split())
# Words in class, id or role that name what is not the article.
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar aside footer header masthead cookie cookies consent notice notices gdpr newsletter subscribe"
    " subscription signup login comment comments respond replies disqus related recommended share sharing social"
    " widget popup modal overlay skip search contentinfo complementary form dialog alert".split()
)
# Words that may stand before and after those in one class token: ``site-header`` and ``comment-list`` name chrome,
# ``has-sidebar`` and ``no-comments`` don't.
_PLACES = frozenset("site page main top bottom left right primary secondary global".split())
_PARTS = frozenset(
    "list item items link links box bar block area slot section wrapper wrap container inner outer button buttons body"
    " left right top bottom primary secondary".split()
)
# What readers and advertisers add is named by the last word, whoever it is said of: ``user-comments``, ``author-notice``.
ADDED_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion cookie cookies consent notice notices gdpr"
    " newsletter comment comments respond replies disqus".split()
)
# Words that say of something else that it has these, or has none: ``has-comments``, ``without-ads``.
_SAID_OF = frozenset("no not non has have with without hide show is before after above below".split())
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre"
    " section table ul".split()
)


def _names_chrome(value: str) -> bool:
    for token in value.split():
        words = [w.lower() for w in _NAMES.findall(token)]
        while words and words[0] in _PLACES:
            words.pop(0)
        while words and (words[-1] in _PARTS or words[-1].isdigit()):
            words.pop()
        if words and all(w in CHROME_NAMES for w in words):
            return True
        if words and words[-1] in ADDED_NAMES and not _SAID_OF.intersection(words):
            return True
    return False


def _chrome(name: str, attributes: str) -> int:
    """2 for what is never the article, 1 for what is not but may hold it, else 0."""
    kind = 0 if name not in CHROME else 1 if name in ("form", "fieldset") else 2
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        value = values[0] or values[1] or values[2]
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 2
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return 2
        if key in ("class", "id", "role") and name not in ("html", "body", "main") and _names_chrome(value):
            kind = max(kind, 1)
    return kind


def _raw_end(page: str, name: str, at: int) -> int:
    """Where the end tag of a raw element that began before ``at`` ends; -1 without one."""
    begin = "/?" if name in NEVER_NESTED else "/"
    found = re.compile(rf"<{begin}{name}(?=[\s/>])", re.I).search(page, at)
    return page.find(">", found.end()) + 1 or -1 if found and found[0][1] == "/" else -1


class _Marks:
    """Where tags of a page end once one was found that never does; every look is answered from what is known.

    ``marks`` are the places of all quotes and ``>``. A place that a failed look met outside quotes is dead: whoever
    meets it outside quotes fails as well. So each place is followed once, and a page of any shape takes linear time.
    """

    def __init__(self, page: str):
        self.page = page
        self.marks = [m.start() for m in _QUOTES.finditer(page)]
        self.dead: set[int] = set()
        self.known = (0, -1)  # from the first place on, the next end of a name is at the second

    def tag(self, at: int) -> tuple[str, str, str, int] | None:
        """Slash, name, attributes and end of the tag that begins at ``at``."""
        begin = at + 2 if self.page[at + 1] == "/" else at + 1
        stop = self._name_end(begin)
        end = -1 if stop < 0 else self._end(stop)
        return None if end < 0 else (self.page[at + 1 : begin], self.page[begin:stop], self.page[stop : end - 1], end)

    def _name_end(self, at: int) -> int:
        since, until = self.known
        if not since <= at <= until and not (until < 0 and 0 < since <= at):
            found = _NAME_ENDS.search(self.page, at)
            self.known = at, found.start() if found else -1
        return self.known[1]

    def _end(self, at: int) -> int:
        met, i = [], bisect_left(self.marks, at)
        while i < len(self.marks):
            place = self.marks[i]
            if self.page[place] == ">":
                return place + 1
            if place in self.dead:
                break
            met.append(place)
            closing = self.page.find(self.page[place], place + 1)
            if closing < 0:
                break
            i = bisect_left(self.marks, closing + 1)
        self.dead.update(met)
        return -1


def _markup(page: str) -> Iterator[tuple[int, int, str, str | None, str]]:
    """All markup in page order: ``start, end, slash, name, attributes``; comments and declarations have no name."""
    at, marks, closed = 0, None, True
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            end = end if end > 2 else len(page)
            yield at, end, "", None, ""
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1 if closed else 0
            closed = end > 0
            if not closed:
                at += 1
                continue
            yield at, end, "", None, ""
        elif not _BEGINS_TAG.match(page, at):
            at += 1
            continue
        else:
            if marks is None:
                found = _TAG.match(page, at)
                tag = (*found.groups(), found.end()) if found else None
                marks = marks if found else _Marks(page)
            else:
                tag = marks.tag(at)
            if tag is None:
                at += 1
                continue
            slash, name, attributes, end = tag
            # Where a raw element ends, the reader says.
            further = yield at, end, slash, name.lower(), attributes
            if further is not None:
                yield
                end = further
        at = end


class _Open:
    """The open elements, with what end tags ask of them at hand: nothing walks the stack."""

    def __init__(self) -> None:
        # Name, in content, in chrome, content in chrome; blocks up to here; place of the last element no <p> reaches over.
        self.stack: list[tuple[str, bool, int, bool, int, int]] = [("", False, 0, False, 0, 0)]
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, content: bool, chrome: int, late: bool) -> None:
        _, _, _, _, blocks, barrier = self.stack[-1]
        place = len(self.stack)
        self.places.setdefault(name, []).append(place)
        inline = name in INLINE
        self.stack.append(
            (name, content, chrome, late, blocks + (not inline), barrier if inline or name == "p" else place)
        )

    def last(self, name: str) -> int:
        """Place of the innermost open element of a name, 0 without one."""
        places = self.places.get(name)
        return places[-1] if places else 0

    def holds_blocks(self, place: int) -> bool:
        return self.stack[-1][4] > self.stack[place][4]

    def closed_by(self, name: str) -> int:
        """Place of the element of this name that a sibling's start closes, 0 if there is none within reach."""
        place = self.last(name)
        return place if place and place >= self.stack[-1][5] else 0

    def cut(self, place: int) -> None:
        for name, *_ in self.stack[place:]:
            self.places[name].pop()
        del self.stack[place:]


def blocks_of(page: str | None) -> list[tuple[bool, str]]:
    """Blocks of a page that may be its text, in page order: (inside the content container, text)."""
    return [(kind == ARTICLE, text) for kind, text in kinds_of(page) if kind != CHROME_TEXT]


def kinds_of(page: str | None) -> list[tuple[int, str]]:
    """All blocks of a page in page order: (kind, text).

    A content container inside one that is chrome by its name counts where the page has no other. Time and memory are
    linear in the page, whatever it holds: tags, quotes or comments that never end, elements that are never closed, end
    tags of nothing.
    """
    out: list[tuple[int, str, bool]] = []
    held: list[str] = []
    opened = _Open()
    stack = opened.stack
    open_ended: set[str] = set()
    heads: list[int] = []  # starts of heads not known to have ended

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            _, content, chrome, late, *_ = stack[-1]
            out.append((CHROME_TEXT if chrome else ARTICLE if content else UNDECIDED, text, late))

    def leave_head() -> None:
        if depth := opened.last("head"):
            flush()
            opened.cut(depth)
        heads.clear()

    def hold(text: str) -> None:
        if stack[-1][0] == "head" and not text.isspace():
            leave_head()
        held.append(text)

    if not page:
        return []
    at, marks = 0, _markup(page)
    for start, end, slash, name, attributes in marks:
        if start > at:
            hold(page[at:start])
        at = end
        if name is None:
            continue
        if slash:
            if name not in INLINE:
                flush()
            if depth := opened.last(name):
                if name in INLINE and opened.holds_blocks(depth):
                    continue  # an inline end tag closes no block
                flush() if stack[depth - 1][1:3] != stack[-1][1:3] else None
                opened.cut(depth)
            continue
        if name not in HEAD and heads:
            leave_head()
        closed = attributes.rstrip().endswith("/")
        if name in RAW:
            end = at if closed else -1 if name in open_ended else _raw_end(page, name, at)
            if end < 0 and name in ENDLESS:
                end = len(page)
            if end >= 0:
                if name not in ("svg", "math"):
                    flush()
                at = end
                marks.send(end)
                continue
            if name not in NEVER_NESTED:
                open_ended.add(name)
        if name not in INLINE:
            flush()
        if name in VOID or closed and name in INLINE:
            continue
        if name in _CLOSES_P or name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            if depth := opened.closed_by("p" if name in _CLOSES_P else name):
                flush()
                opened.cut(depth)
        _, content, chrome, late, *_ = stack[-1]
        own = 2 if name == "head" else 0 if content and name == "header" else _chrome(name, attributes)
        if name == "head":
            heads.append(start)
        container = name in CONTENT or 'role="main"' in attributes
        if container and chrome == 1 and not content and not own:
            chrome, late = 0, True
        chrome = max(chrome, own)
        entered = content or container and not chrome
        if (entered, chrome) != (content, stack[-1][2]):
            flush()
        opened.push(name, entered, chrome, late)
    if at < len(page):
        hold(page[at:])
    flush()
    other = any(kind == ARTICLE and not late for kind, _, late in out)
    return [(CHROME_TEXT if late and other else kind, text) for kind, text, late in out]


def run_ranks(streams: list[np.ndarray], run: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the streams, one after the other: the number of its run of ``run`` tokens, and whether the run
    ends inside the stream; only then does the number mean anything.

    A suffix array sorted by its first ``run`` tokens, by prefix doubling; neighbours of one rank share them.
    ``streams`` hold token numbers from 1 on.
    """
    sizes = np.array([len(s) + 1 for s in streams])
    text = np.concatenate([x for s in streams for x in (s, [0])]).astype(np.int64)
    n = len(text)
    # Windows that reach over the end of a stream never count; a separator of its own keeps them apart.
    ends = np.cumsum(sizes) - 1
    text[ends] = text.max() + 1 + np.arange(len(ends))
    rank, width = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while width < run:
        step = min(width, run - width)
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64)
        width += step
    tokens = np.ones(n, dtype=bool)
    tokens[ends] = False
    inside = np.arange(n) + run <= np.repeat(ends, sizes)
    return rank[tokens], inside[tokens]


def page_counts(rank: np.ndarray, owner: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """For each place: on how many pages, told by ``owner``, its run stands at places that are ``counted``."""
    several = owner.max(initial=0) + 1
    pairs = np.unique(rank[counted] * several + owner[counted])
    return np.bincount(pairs // several, minlength=rank.max(initial=0) + 1)[rank]


def _cover(starts: np.ndarray, run: int) -> np.ndarray:
    """Tokens that lie in a run from one of the marked places on."""
    edges = np.zeros(len(starts) + run + 1, dtype=np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + run, -1)
    return np.cumsum(edges)[: len(starts)] > 0


def repeated_tokens(
    streams: list[np.ndarray], pages: np.ndarray, run: int, least: int = 2
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each stream: which tokens lie in a run of ``run`` tokens that ``least`` pages have, and the windows that don't."""
    rank, inside = run_ranks(streams, run)
    sizes = [len(s) for s in streams]
    count = page_counts(rank, np.repeat(np.unique(pages, return_inverse=True)[1].astype(np.int64), sizes), inside)
    cuts = np.cumsum(sizes)[:-1]
    return (
        [_cover(starts, run) for starts in np.split(inside & (count >= least), cuts)],
        [np.flatnonzero(open_) for open_ in np.split(inside & (count < least), cuts)],
    )


class _Slice:
    """The blocks of some pages of a host (``packed``) as token streams, in the order of ``pdf``.

    A block is a stream of its own, so no run reaches over a block's end. A block shorter than ``run`` is filled up with end
    marks: it is repeated as a whole or not at all.
    """

    def __init__(self, pdf: pd.DataFrame, run: int):
        self.run, self.marks = run, pdf["mark"].tolist()
        words: list[str] = []
        pages, sizes, kinds = [], [], []
        for page, packed in enumerate(pdf["packed"]):
            for block in zlib.decompress(packed).decode().split("\n"):
                tokens = block[1:].split(" ")
                pages.append(page)
                kinds.append(int(block[0]))
                sizes.append(len(tokens))
                words += tokens
                words += ["\n"] * (run - len(tokens))
        self.pages, self.sizes, self.kinds = pages, np.array(sizes, dtype=np.int64), np.array(kinds)
        self.filled = np.maximum(self.sizes, run)
        self.cuts = np.cumsum(self.filled)[:-1]
        self.codes, self.words = pd.factorize(np.array(words, dtype=object))
        self.owner = np.repeat(np.array(pages, dtype=np.int64), self.filled)
        self.undecided = np.repeat(self.kinds == UNDECIDED, self.filled)

    def ranks(self) -> tuple[np.ndarray, np.ndarray]:
        return run_ranks(np.split(self.codes + 1, self.cuts), self.run)

    def inside(self) -> np.ndarray:
        """Places whose run ends inside its stream."""
        ends = np.repeat(np.cumsum(self.filled), self.filled)
        return np.arange(len(self.codes)) + self.run <= ends

    def digests(self) -> np.ndarray:
        """A digest of the run at each place; the same run has the same one in every slice."""
        import xxhash

        known = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in self.words], dtype=np.uint64)
        tokens = np.concatenate([known[self.codes], np.zeros(self.run, dtype=np.uint64)])
        made = np.zeros(len(self.codes), dtype=np.uint64)
        for step in range(self.run):
            made = (made + tokens[step : step + len(made)]) * np.uint64(0x9E3779B97F4A7C15)
            made ^= made >> np.uint64(29)
        return made.view(np.int64)

    def covered(self, starts: np.ndarray) -> Iterator[tuple[str, list[int]]]:
        """Mark of each page with undecided tokens in a run from one of the marked places on, and their places.

        Places are those of the page's undecided tokens, one block after the other.
        """
        found: dict[int, list[int]] = {}
        before = dict.fromkeys(self.pages, 0)
        for page, kind, size, own in zip(self.pages, self.kinds, self.sizes, np.split(starts, self.cuts), strict=True):
            if kind != UNDECIDED:
                continue
            if own.any():
                at = before[page] + np.flatnonzero(_cover(own, self.run)[:size])
                found.setdefault(page, []).extend(at.tolist())
            before[page] += int(size)
        for page, at in found.items():
            yield self.marks[page], at


_COVERED = "host string, mark string, covered array<int>"


def _packed(sliced: DataFrame) -> DataFrame:
    """Pages with their ``blocks`` packed for the shuffle, which packs rows of many pages half as well.

    ``blocks`` is a text with a line a block, its kind first; no block holds a line end.
    """
    at = sliced.columns.index("blocks")
    fields = [T.StructField("packed", T.BinaryType()) if f.name == "blocks" else f for f in sliced.schema.fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([zlib.compress(t.encode(), 1) for t in columns[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return sliced.mapInArrow(pack, T.StructType(fields))


def _slice_runs(run: int):
    """Covered token places of each page of a slice; of a host in several slices the runs that may be frequent, by digest.

    A run that enough pages of the host have stands on as many pages of one slice as its even share, at least.
    """

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        host, slices = pdf["host"].iloc[0], int(pdf["slices"].iloc[0])
        least, least_open = (-(-int(pdf[c].iloc[0]) // slices) for c in ("least", "least_open"))
        own = _Slice(pdf, run)
        rank, inside = own.ranks()
        frequent = inside & (
            (page_counts(rank, own.owner, inside) >= least)
            | (page_counts(rank, own.owner, inside & own.undecided) >= least_open)
        )
        if slices == 1:
            rows = [(host, mark, at, None) for mark, at in own.covered(frequent)]
        elif pdf["asked"].iloc[0] and frequent.any():
            rows = [(host, None, None, np.unique(own.digests()[frequent]).tolist())]
        else:
            rows = []
        return pd.DataFrame(rows, columns=["host", "mark", "covered", "likely"])

    return work


def _slice_counts(run: int):
    """On how many pages of a slice each of the asked runs stands: on all, and in undecided blocks alone."""

    def work(pdf: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = ["host", "run", "n", "n_open"]
        if pdf.empty or asked.empty:
            return pd.DataFrame([], columns=names)
        own, runs = _Slice(pdf, run), np.sort(asked["run"].to_numpy())
        digests = own.digests()
        found = own.inside() & np.isin(digests, runs)
        at, owner, undecided = np.searchsorted(runs, digests[found]), own.owner[found], own.undecided[found]
        several = owner.max(initial=0) + 1
        n, n_open = (
            np.bincount(np.unique((at * several + owner)[which]) // several, minlength=len(runs))
            for which in (np.ones(len(at), dtype=bool), undecided)
        )
        made = pd.DataFrame({"host": asked["host"].iloc[0], "run": runs, "n": n, "n_open": n_open})
        return made[made["n"] > 0]

    return work


def _slice_covered(run: int):
    """Token places of each page of a slice that the given runs cover."""

    def work(pdf: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if not pdf.empty and not asked.empty:
            own = _Slice(pdf, run)
            starts = own.inside() & np.isin(own.digests(), asked["run"].to_numpy())
            rows = [(pdf["host"].iloc[0], mark, at) for mark, at in own.covered(starts)]
        return pd.DataFrame(rows, columns=["host", "mark", "covered"])

    return work


def _frequent_runs(sliced: DataFrame, likely: DataFrame, hosts: DataFrame, run: int) -> DataFrame:
    """``host, mark, covered`` of pages of hosts in several slices: likely runs are counted in all slices of their host."""

    def everywhere(runs: DataFrame) -> DataFrame:
        slices = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
        return runs.join(hosts.select("host", "slices"), "host").select("host", slices, "run")

    # Only hosts with a run to ask for are dealt out again.
    asked = common.written(likely.distinct(), "html-likely")
    several = sliced.where((F.col("slices") > 1) & F.col("asked"))
    counts = _packed(several).groupBy("host", "slice").cogroup(everywhere(asked).groupBy("host", "slice"))
    counts = counts.applyInPandas(_slice_counts(run), "host string, run bigint, n bigint, n_open bigint")
    summed = counts.groupBy("host", "run").agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open"))
    enough = (F.col("n") >= F.col("least")) | (F.col("n_open") >= F.col("least_open"))
    frequent = summed.join(hosts.select("host", "least", "least_open"), "host").where(enough).select("host", "run")
    frequent = common.written(frequent, "html-frequent")
    pages = _packed(several.where("undecided")).groupBy("host", "slice").cogroup(everywhere(frequent).groupBy("host", "slice"))
    return pages.applyInPandas(_slice_covered(run), _COVERED)


def extract_text(pages: DataFrame, run: int = RUN) -> DataFrame:
    """All columns of ``pages`` with the main ``text`` added (``_text`` and so on where the name is taken).

    Needs ``url`` and ``html``. A null or empty page, and one without text blocks, has an empty text. Character
    references are decoded, white space inside a block is one space, blocks are joined by one space. Hosts compare
    without case; pages without a host share the empty one. Copies of a page under one host are one page, so they
    all keep what a single one keeps. Rows are kept as they are, repeated ones too.
    """
    text, parts, page, site, mark, size = (
        common.free_name(pages, n) for n in ("text", "parts", "page", "site", "mark", "size")
    )
    block = T.ArrayType(T.StructType([T.StructField("kind", T.ByteType()), T.StructField("text", T.StringType())]))
    at = pages.columns.index("html")
    arrow = pa.list_(pa.struct([("kind", pa.int8()), ("text", pa.string())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, batch_html):
            found = [
                [{"kind": k, "text": t} for k, t in kinds_of(p)] for p in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*kept(batch), pa.array(found, arrow)], names=[*others, parts])

    batch_html = pages.columns[at]
    others = [c for c in pages.columns if c != batch_html]

    def kept(batch: pa.RecordBatch) -> list:
        return [c for i, c in enumerate(batch.columns) if i != at]

    fields = [f for f in pages.schema.fields if f.name != batch_html]
    parsed = pages.mapInArrow(parse, T.StructType([*fields, T.StructField(parts, block)]))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1))
    own_text = F.filter(F.col(parts), lambda b: b["kind"] != CHROME_TEXT)
    whole = F.array_join(F.transform(own_text, lambda b: F.concat(b["kind"].cast("string"), F.lit(" "), b["text"])), "\n")
    length = F.length(F.array_join(F.transform(F.col(parts), lambda b: b["text"]), " "))
    parsed = parsed.withColumns(
        {
            page: F.monotonically_increasing_id(),
            site: host,
            mark: F.when(F.size(parts) > 0, F.md5(whole.cast("binary"))),
            size: length,
        }
    )
    parsed = common.written(parsed, "html-blocks")
    undecided = F.exists(F.col(parts), lambda b: b["kind"] == UNDECIDED)

    # Of pages with equal text one stands for all; the others are few as a rule, and told by their numbers alone.
    places = parsed.where(F.col(mark).isNotNull()).select(
        F.col(page).alias("page"), F.col(site).alias("host"), F.col(mark).alias("mark")
    )
    first = places.groupBy("host", "mark").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = common.written(places.join(first, ["host", "mark"]).where("page <> first").select("page"), "html-copies")
    streams = parsed.where(F.col(mark).isNotNull()).select(
        F.col(page).alias("page"), F.col(site).alias("host"), F.col(mark).alias("mark"), F.col(size).alias("size"),
        F.col(parts).alias("parts"), undecided.alias("undecided"),
    )
    streams = common.with_bounded_side(streams, copies, "page", "left_anti")

    def enough(n: str) -> Column:
        return F.when(F.col(n) < SHARE, 3).otherwise(F.greatest(F.lit(2), F.ceil(F.col(n) / SHARE))).cast("int")

    hosts = streams.groupBy("host").agg(
        F.sum("size").alias("chars"), F.count(F.lit(1)).alias("n"), F.count_if("undecided").alias("n_open")
    )
    hosts = hosts.select(
        "host",
        F.greatest(F.lit(1), F.ceil(F.col("chars") / (6 * SLICE_TOKENS))).cast("int").alias("slices"),
        enough("n").alias("least"),
        enough("n_open").alias("least_open"),
        (F.col("n_open") > 0).alias("asked"),
    )
    hosts = common.written(hosts, "html-hosts")
    few = hosts.limit(common.BROADCAST_IDS + 1).count() <= common.BROADCAST_IDS
    hosts = F.broadcast(hosts) if few else hosts
    sliced = streams.join(hosts, "host").select(
        "host", F.pmod(F.xxhash64("mark"), F.col("slices")).cast("int").alias("slice"), "mark",
        "least", "least_open", "slices", "asked", "undecided",
        F.array_join(F.transform("parts", lambda b: F.concat(b["kind"].cast("string"), b["text"])), "\n").alias("blocks"),
    )
    marked = _packed(sliced).groupBy("host", "slice").applyInPandas(_slice_runs(run), f"{_COVERED}, likely array<bigint>")
    marked = common.written(marked, "html-runs")
    gone = marked.where(F.col("mark").isNotNull()).select("host", "mark", "covered")
    likely = marked.where(F.col("likely").isNotNull()).select("host", F.explode("likely").alias("run"))
    if likely.limit(1).count():
        gone = gone.unionByName(common.written(_frequent_runs(sliced, likely, hosts, run), "html-covered"))
    gone = gone.select(F.col("host").alias(site), F.col("mark").alias(mark), F.col("covered").alias("gone"))
    plain = F.array_join(F.transform(own_text, lambda b: b["text"]), " ")
    own = [parts, page, site, mark, size]
    if gone.limit(1).count() == 0:
        return parsed.withColumn(text, plain).drop(*own)
    # Pages that markup decides meet nothing and stay where they are.
    joined = parsed.where(undecided).join(gone, [site, mark], "left")
    filled = joined.withColumn(text, F.when(F.col("gone").isNull(), plain).otherwise(_without(F.col(parts), F.col("gone"))))
    decided = parsed.where(~F.coalesce(undecided, F.lit(False))).withColumn(text, plain)
    wanted = [F.col(c) for c in parsed.columns if c not in own] + [F.col(text)]
    return filled.select(wanted).unionByName(decided.select(wanted))


def _without(parts, gone):
    """Blocks joined, with the given token places of the undecided stream taken out."""
    numbered = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("kept")),
        lambda s, b: F.struct(
            F.when(b["kind"] == UNDECIDED, s["at"] + F.size(F.split(b["text"], " "))).otherwise(s["at"]).alias("at"),
            F.when(b["kind"] == CHROME_TEXT, s["kept"])
            .when(b["kind"] == ARTICLE, F.concat(s["kept"], F.array(b["text"])))
            .otherwise(
                F.concat(
                    s["kept"],
                    F.filter(F.split(b["text"], " "), lambda w, i: ~F.array_contains(gone, s["at"] + i)),
                )
            )
            .alias("kept"),
        ),
    )
    return F.array_join(numbered["kept"], " ")
