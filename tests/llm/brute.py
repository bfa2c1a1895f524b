"""Plain re-computations of what the operators' queries return, for small tables."""

from __future__ import annotations

import hashlib
import html
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def lower(text):
    return (text or "").translate(_UPPER)


def words(text):
    return WORD.findall(lower(text))


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def encoded(texts):
    tool = tokenizer()
    return [tool.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def jaccard(rows, size=4, percent=85):
    """``{doc_id: (n_shingles, component_id, n_links)}`` of (doc_id, text) rows with distinct ids."""
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    ids = sorted(sets)
    parent, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if not x or not y or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            same = len(x & y)
            if 100 * same >= percent * (len(x) + len(y) - same):
                links[a] += 1
                links[b] += 1
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i), links[i]) for i in ids}


def contaminated(docs, items, window=13):
    """``{doc_id: (n_words, n_hit, n_items, digest, contaminated)}``."""
    wanted = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(n, {}).setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n, windows in wanted.items():
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= owners
        found.discard(None)
        names = ",".join(sorted(map(str, found)))
        out[doc_id] = (
            len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)
        )
    return out


def sentences(text):
    """Paragraphs, which a line without a word ends, cut where a sentence does."""
    held, out = [], []
    for line in [*re.split(r"\r\n|\n|\r", lower(text)), ""]:
        if WORD.search(line):
            held.append(line)
        elif held:
            out += re.split(r"[.!?;][ \t\n\x0b\f\r]+", "\n".join(held))
            held = []
    return out


PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


def base_license(text):
    """``n_words, n_base, first_word, last_word, base_labels``."""
    w, at, labels = words(text), [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def url_verdict(url, rules, default="allow"):
    """``host, path, rule, verdict``."""
    if url is None or "://" not in url:
        return "", "", None, default
    found = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    host, path = lower(found[1]), found[2]
    fitting = [
        (h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule, verdict = max(fitting, key=lambda r: len(r[0]), default=(None, default))
    return host, path, rule, verdict


def nearest(rows, k=10, every=100):
    """``{query: [(vec_id, distance)]}`` by brute force over usable vectors of (vec_id, vector) rows."""
    kept = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in list(v)
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    ids = np.array(sorted(kept))
    x = np.stack([kept[i] for i in ids]) if len(ids) else np.zeros((0, 1))
    out = {}
    for i in ids[ids % every == 0]:
        d = np.sqrt(((x - kept[i]) ** 2).sum(axis=1))
        order = np.lexsort((ids, d))
        out[int(i)] = [(int(ids[j]), float(d[j])) for j in order if ids[j] != i][:k]
    return out


def article(page):
    """Text of the one article of a generated page."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner[1])) if inner else []
    return " ".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def auc(score, label):
    score, label = np.asarray(score, float), np.asarray(label)
    order = score.argsort(kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    for value in np.unique(score):
        ranks[score == value] = ranks[score == value].mean()
    up = label == 1
    return (ranks[up].sum() - up.sum() * (up.sum() + 1) / 2) / (up.sum() * (~up).sum())
