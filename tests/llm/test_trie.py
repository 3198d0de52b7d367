"""The prefix trie against a plain one: nulls, ties, repeated turns, long conversations over several stretches, many copies, empty tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tapeline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, conv string, last int, pos string"


def sha(said):
    return hashlib.sha256(said.encode()).hexdigest()


def originals(rows):
    convs = {}
    for c, *turn in rows:
        convs.setdefault(c, []).append(turn)
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
    return {c: [(r or "", x or "") for _, r, x in turns] for c, turns in convs.items()}


def rebuilt(rows):
    convs = originals(rows)
    out = {}
    for c, turns in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = None if c is None else c - int(np.fmod(c, 100))
        out[c] = convs.get(base, [])[:h] + turns[h:] if h else turns
    return out


def brute(paths):
    big = lambda c: (c is None, c or 0)
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    least = {node: min(m, key=big) for node, m in members.items()}
    children, leaves, saved = ({node: 0 for node in members} for _ in range(3))
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        value = (len(own) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += not children[node]
    rows = []
    for node, own in members.items():
        ends = sorted((c for c in own if len(paths[c]) == len(node)), key=big)
        said = sha(",".join("null" if c is None else str(c) for c in ends))
        rows.append((least[node], len(node), least[node[:-1]] if node else None, len(own), children[node], leaves[node], saved[node], said))
    return sorted(rows, key=str)


def conversations():
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 330, 3), 100, 200, 401, 405, -7, -100, -150, 10**12 + 5]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["hi", "yé", "", None])))
    rows += [(500 + i, t, "user", f"same {t}") for i in range(40) for t in range(7)]  # copies
    rows += [(700, t, "bot", str(t % 5)) for t in range(60)] + [(701, t, "bot", str(t % 5)) for t in range(75)]  # long
    rows += [(800, None, "a", "x"), (800, None, "a", "x"), (800, 3, "b", "y"), (800, 3, "a", "z"), (800, -1, "c", "漢字")]
    rows += [(None, 1, "a", "x"), (None, None, "b", "t"), (901, 1, "x", "alone")]
    rows += [(1000, 1, "u", "long " * 50_000), (1001, 1, "u", "long " * 50_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "clash", 1, "clash") for r in rows], SCHEMA).repartition(4)


def result(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize(("stretch", "shard", "ids"), [(1024, 100_000, 256), (4, 50, 3)])
def test_rebuilt_trie(spark, stretch, shard, ids):
    rows = conversations()
    turns = trie.ordered_turns(frame(spark, rows))
    assert result(trie.prefix_trie(trie.rebuilt(turns), stretch, shard, ids)) == brute(rebuilt(rows))


def test_trie_as_it_is(spark):
    rows = conversations()
    turns = trie.ordered_turns(frame(spark, rows))
    assert result(trie.prefix_trie(trie.as_paths(turns), stretch=8)) == brute(originals(rows))


def test_empty_table(spark):
    turns = trie.ordered_turns(frame(spark, [(1, 1, "a", "b")]).limit(0))
    assert result(trie.prefix_trie(trie.rebuilt(turns))) == []


def test_node_table():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000, 40_000):
        low, high = (rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64) for _ in range(2))
        low[: n // 2] = low[n // 2 : n // 2 * 2]  # halves of keys repeat
        table = trie.NodeTable(low, high)
        slots = table.slots(low, high)
        assert sorted(slots.tolist()) == list(range(n))
        assert (table.slots(low + np.uint64(1), high) < 0).all()
    with pytest.raises(ValueError, match="distinct"):
        trie.NodeTable(np.array([5, 5], np.uint64), np.array([6, 6], np.uint64))
