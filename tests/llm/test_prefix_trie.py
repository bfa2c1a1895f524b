"""Operator 13 against a trie grown turn by turn."""

import hashlib
import random
import zlib

import pytest

from silverbrook.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, Path int, depth int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(5)


def key_of(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def conversations(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], key_of(t[1], t[2])))
    own = {c: [(r, x) for _, r, x in turns] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        block = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = own.get(block, [])[:h] + turns[h:]
    return made


def brute(rows):
    made, members = conversations(rows), {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, ids in members.items():
        ended = sorted(c for c in ids if len(made[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()
        out.append((min(ids), len(node), parent, len(ids), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def of(df):
    return sorted((tuple(r) for r in df.drop("digest", "parent").collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    words = ["hi", "yes", "no", "ünï🙂", "tell me", ""]
    out = []
    for conv in [*range(0, 230), *range(-120, -100), 900, 901, 1050]:
        for turn in range(draw.choice([1, 2, 3, 4, 6, 8])):
            out.append((conv, turn * 3 - 1, draw.choice(["user", "assistant", None]), draw.choice(words + [None])))
    # One opening shared by very many different conversations, and very many copies of one conversation.
    for conv in range(2000, 2150):
        out += [(conv, t, "user", "the same opening") for t in range(7)] + [(conv, 7, "user", f"own {conv}"), (conv, 8, "user", "end")]
    for conv in range(3001, 3100):
        out += [(conv, t, "user", f"copied {t}") for t in range(6)]
    out += [(4000, t, "user", f"long {t % 7}") for t in range(70)] + [(4100, t, "user", f"long {t % 7}") for t in range(40)]
    # Null and equal turns, repeated rows, no id.
    out += [(5000, None, "user", "first"), (5000, 0, "b", "x"), (5000, 0, "a", "y"), (5000, 0, "a", "x"), (5000, 0, "a", "x"), (None, 0, "user", "lost")]
    out += [(6000, 0, "user", "z" * 100_000), (6001, 0, "user", "z" * 100_000)]
    return out


@pytest.mark.parametrize(
    ("share", "most", "least", "chunk"),
    [(1 / 64, 1 << 16, 1 << 10, 1 << 17), (0.0, 1, 1, 1), (0.0, 60, 60, 10), (1.0, 1 << 30, 1 << 30, 50)],
)
def test_trie_equals_brute_force(spark, monkeypatch, rows, share, most, least, chunk):
    for name, value in (("GROUP_SHARE", share), ("GROUP_MOST", most), ("GROUP_LEAST", least), ("CHUNK_TURNS", chunk)):
        monkeypatch.setattr(prefix_trie, name, value)
    some = rows if most > 1 else [r for r in rows if r[0] is not None and not 4000 <= r[0] < 4200]
    assert of(prefix_trie.prefix_trie(frame(spark, some))) == brute(some)


def test_long_lists_of_ended_conversations_are_hashed_in_pieces(spark, monkeypatch, rows):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    assert of(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_trie_of_few_or_no_conversations(spark):
    assert of(prefix_trie.prefix_trie(frame(spark, []))) == []
    assert of(prefix_trie.prefix_trie(frame(spark, [(None, 1, "user", "x")]))) == []
    # All own turns are replaced by those of an absent conversation.
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(turnless, t, "user", "x") for t in range(5)]
    assert of(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)
    assert len(brute(rows)) == 1


def test_nodes_name_their_parents(spark, rows):
    nodes = prefix_trie.prefix_trie(frame(spark, rows)).collect()
    by_digest = {bytes(n.digest): n for n in nodes}
    assert len(by_digest) == len(nodes)
    for n in nodes:
        if n.depth:
            parent = by_digest[bytes(n.parent)]
            assert (parent.depth, parent.conv_id) == (n.depth - 1, n.parent_conv_id)
        else:
            assert n.parent is None and n.parent_conv_id is None
