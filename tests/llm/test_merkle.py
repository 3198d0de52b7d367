"""The Merkle manifest against a plain tree: nulls, ties, repeated rows, long texts, clashing columns, several rounds of blocks."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tapeline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, digest string, row string, n int, pos int"


def sha(said: str) -> str:
    return hashlib.sha256(said.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(digests):
    """The root, and for each leaf its siblings level by level."""
    proofs = [[] for _ in digests]
    nodes = [(d, [i]) for i, d in enumerate(digests)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k, (_, members) in enumerate(run):
                for m in members:
                    proofs[m] += [d for j, (d, _) in enumerate(run) if j != k]
            above.append((sha("".join(d for d, _ in run)), [m for _, members in run for m in members]))
        nodes = above
    return nodes[0][0], proofs


def brute(rows):
    leaf = [sha("".join(map(field, r[:5]))) for r in rows]
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[1], []).append(i)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, own = [], {}
    for name in names:
        members = sorted(groups[name], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
        subroot, proofs = tree([leaf[i] for i in members])
        subroots.append(subroot)
        own |= dict(zip(members, proofs))
    root, upper = tree(subroots)
    return sorted((str(r[0]), leaf[i], subroots[names.index(r[1])], root, sha("".join(own[i] + upper[names.index(r[1])]))) for i, r in enumerate(rows))


def documents():
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "b", "é", "z", "a", ""]) if i % 3 else "hot", None if i % 7 == 0 else "en", i, f"text {i}\nx") for i in range(1200)]
    rows += [(None, "hot", "x", None, None), (5, "b", "q", 1, ""), (5, "b", "q", 1, ""), (5, "b", "r", 1, ""), (3, "solo", "q", 1, "long " * 200_000)]
    return rows + [(-4, f"s{i}", None, -1, "漢\n") for i in range(100)]


@pytest.mark.parametrize("n", [None, 2, 1, 0])
def test_manifest(spark, n):
    rows = documents()[:n]
    df = spark.createDataFrame([(*r, 1, "clash", "clash", 2, 3) for r in rows], SCHEMA).repartition(5)
    out = merkle.manifest(df, extra={"again": F.col("text")}).withColumn("said", merkle.proof_digest(F.col("proof"))).collect()
    got = sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["said"]) for r in out)
    assert got == (brute(rows) if rows else [])
    assert sorted(str(r["again"]) for r in out) == sorted(str(r[4]) for r in rows)


def test_fold_tells_changed_leaves(spark):
    rows = documents()[:300]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    out = merkle.manifest(df)
    changed = F.when(F.col("doc_id") % 2 == 0, F.sha2("leaf", 256)).otherwise(F.col("leaf"))
    for r in out.withColumn("again", merkle.fold(changed, F.col("proof"))).collect():
        assert (r["again"] == r["root"]) == (r["doc_id"] % 2 == 1)


def test_one_block_and_one_queue():
    digests = [sha(str(i)) for i in range(70)]
    block = merkle.Block(digests, 0, 70)
    root, proofs = tree(digests)
    assert block.climb() == root
    assert ["".join(a + b for a, b in p) for p in block.descend([])] == ["".join(p) for p in proofs]
