import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from trailfeat.llm import prefix_trie as P

CONV = "conv_id long, turn long, role string, text string"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def plain(rows):
    """Every node by loops: (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, turn_key(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c - np.fmod(c, 20))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = sum(saved[k] for k in kids[path]) + (len(members[path]) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p, m in members.items())


def rows_of(conversations, **kw):
    found = P.prefix_trie(P.rebuilt(P.turns_of(conversations)), **kw)
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[1]))


def test_table_is_minimal_perfect_and_verified():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, (50_000, 2)).astype(np.uint64), axis=0)
    table = P.NodeTable(keys[:40_000])
    slots = table.slots(keys)
    assert sorted(slots[:40_000]) == list(range(40_000))
    assert (slots[40_000:] == -1).all()
    half = keys[:1000].copy()
    half[:, 1] = 7  # one half equal is no match
    assert (table.slots(half) == -1).all()
    assert len(P.NodeTable(keys[:0]).slots(keys[:5])) == 5


@pytest.mark.parametrize("shards", [1, 7, 60])
def test_conversations_equal_loops(spark, shards):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert rows_of(table, least_shards=shards) == plain([tuple(r) for r in table.collect()])


def test_hot_groups_span_shards(spark, monkeypatch):
    """A first turn, a node and whole conversations that most share are dealt over shards and summed whole."""
    monkeypatch.setattr(P, "PACKET_IDS", 7)
    rows = []
    for c in range(900):
        rows += [(c, 0, "user", "hello there"), (c, 1, "bot", "hi" if c % 3 else f"other {c % 5}")]
        rows += [(c, 2 + k, "user", f"more words {k} {c % 4 if c % 10 == 0 else 0}") for k in range(c % 3)]
    table = spark.createDataFrame(rows, CONV)
    assert rows_of(table, shard_turns=50, least_shards=3) == plain(rows)


def test_odd_rows(spark):
    long_text = "w " * 200_000
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 0, "user", ""), (5, 1, "user", "a b"), (6, 0, None, "a b"),
            (6, 0, "user", "tie b"), (6, 0, "user", "tie a"), (6, 0, "user", "tie a"), (26, 0, "x", " \n\t "), (27, 0, "x", long_text),
            (28, 0, "x", long_text), (-3, 0, "x", "é 🙂"), (41, 0, "u", "1"), (48, 3, "u", "late"), (40, 0, "u", "base"),
            (40, 1, "u", "base2"), (60, 0, "u:", "x"), (61, 0, "u", ":x")]
    rows += [(70, k, "deep", f"turn {k}") for k in range(300)]
    extra = spark.createDataFrame([(*r, 1, "q", 3) for r in rows], CONV + ", d int, shard string, digest int")
    assert rows_of(extra, shard_turns=4, least_shards=2) == plain(rows)


def test_no_conversations(spark):
    assert rows_of(spark.createDataFrame([], CONV)) == []
    assert rows_of(spark.createDataFrame([(None, 1, "u", "x")], CONV)) == []
