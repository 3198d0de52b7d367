"""Each operator against a plain version of itself: small texts, nulls, empty ones, ties, repeats, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from tapeline.llm import bpe, chat, exact_dedup, licenses, lm, packing, quality, sharding, simhash, suffix_dedup
from tapeline.llm.components import connected_components
from tapeline.llm.queries import QUERIES
from tapeline.llm.sql import ORACLES

WORD = r"[^\x20\x09-\x0D]+"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, kept int, shard string, row string"
ODD = [None, "", " ", "\n\n", "a", "A b", "é x\ty", "漢字 漢字", "x" * 700, "the end. " * 200, "'s it's 12.5 !!　\x1c\r\n z"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(150)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    out = [make(rng.randint(5, 60)) for _ in range(60)]
    passage = make(30)
    out += [make(10) + "\n" + passage + "\n" + make(8) for _ in range(8)]
    out += [out[0]] * 12 + [out[1]] * 2 + [out[2] + " tail", "head " + out[2]]
    return out + ODD


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, 7, "clash", "clash") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def brute_spans(data, threshold):
    seen, out = set(), []
    for text in data:
        spans = []
        for at in range(len(text) - threshold + 1):
            window = text[at : at + threshold]
            if window not in seen:
                seen.add(window)
            elif spans and at <= spans[-1][1]:
                spans[-1][1] = at + threshold
            else:
                spans.append([at, at + threshold])
        out.append(spans)
    return out


@pytest.mark.parametrize(("threshold", "gram", "common"), [(100, 40, 32), (20, 8, 1), (24, 10, 3)])
def test_suffix_dedup(spark, docs, texts, monkeypatch, threshold, gram, common):
    monkeypatch.setattr(suffix_dedup, "COMMON", common)
    got = by_id(suffix_dedup.removed(docs.repartition(5), threshold=threshold, gram=gram))
    data = [(t or "").encode() for t in texts]
    for i, spans in enumerate(brute_spans(data, threshold)):
        kept, last = b"", 0
        for a, b in spans:
            kept, last = kept + data[i][last:a], b
        kept += data[i][last:]
        expected = (len(data[i]), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        assert tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == expected


def test_suffix_dedup_odd_ids_and_empty(spark, empty):
    long = "abcdefghij" * 15
    rows = spark.createDataFrame([(None, long), (4, long), (4, long), (9, "short")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in suffix_dedup.removed(rows).collect())
    # within one text each string starts again ten bytes on, except from the first ten places
    assert got == [(-1, 140), (4, 150), (4, 150), (9, 0)]
    assert suffix_dedup.removed(empty).count() == 0
    left = {r["doc_id"]: r["text"] for r in suffix_dedup.remove_repeats(rows).collect()}
    assert left == {None: long[:10], 9: "short"}


def test_exact_dedup(docs, texts, empty):
    got = by_id(exact_dedup.mark_copies(docs))
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", []).append(i)
    for t, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (max(ids), len(ids), i == max(ids))
            assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest() and r["shard"] == "clash"
    assert exact_dedup.drop_copies(docs).columns == docs.columns
    assert exact_dedup.drop_copies(docs).count() == len(groups)
    assert exact_dedup.mark_copies(docs, max_slots=64).where("kept").count() == len(groups)  # a full filter only costs
    assert exact_dedup.mark_copies(empty).count() == 0


def brute_print(text):
    words = re.findall(WORD, (text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("small", [256, 2])
def test_ring_filter_loses_no_link(monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(small)
    prints = set()
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(25):
            x = center
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = np.array(sorted(prints), np.uint64)
    near = np.argwhere(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3).tolist()
    links = []
    for keys in simhash.ring_keys(prints, 3):
        order = np.argsort(keys, kind="stable")
        a, b = simhash.link_bucket_members(keys[order], prints[order], 3)
        links += zip(order[a].tolist(), order[b].tolist())
    assert components(len(prints), links) == components(len(prints), near)


def test_simhash(docs, texts, empty):
    got = by_id(simhash.near_copies(docs))
    prints = [brute_print(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    for i, c in enumerate(components(len(texts), near)):
        assert (got[i]["fingerprint"], got[i]["component_id"], got[i]["representative"]) == (f"{prints[i]:016x}", c, i == c)
    assert simhash.drop_near_copies(docs).count() == sum(r["representative"] for r in got.values())
    assert simhash.near_copies(empty).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(500, 800)] + [(3, 3), (9, 8), (8, 9)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in (7, *range(500, 800))}, 8: 8, 9: 8}


def test_shards(docs, texts, empty, spark):
    rows = sharding.shard_documents(docs.withColumnsRenamed({"shard": "source", "row": "lang"}), shards=5).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "bytes", None)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    share, most = sum(sizes.values()) / 5, max(r["size"] for r in rows)
    assert len(sizes) == 5 and all(abs(s - share) <= 2 * most for s in sizes.values())
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert sharding.shard_documents(empty.withColumnsRenamed({"shard": "source", "row": "lang"})).count() == 0


def test_shards_cut_one_source_and_one_text(spark):
    rows = spark.createDataFrame([(i, "same text", "s", "en") for i in range(4000)], "doc_id long, text string, source string, lang string")
    counts = [r["count"] for r in sharding.shard_documents(rows, shards=8, dimensions=("source",)).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) <= 1.05 * 500


def test_quality(docs, texts, empty):
    got = by_id(quality.judge(docs))
    for i, text in enumerate(t or "" for t in texts):
        words = re.findall(WORD, text)
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        times = Counter(windows)
        inside = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(8)}
        base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base
        assert got[i]["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        assert not (got[i]["kept"] and got[i]["base_failed"])
    assert quality.judge(empty).count() == 0


def test_quality_lines(spark):
    prose = "\n".join(" ".join(f"word{i}x{j}" for j in range(10)) + "." for i in range(6))  # no window comes twice
    menu = "\n".join("Home | News | About | Contact | Help" for _ in range(6))
    rows = [(1, prose), (2, prose + "\nAll rights reserved.\nHome | About | Help |"), (3, prose.split("\n")[0] + "\n" + menu), (4, re.sub(r"(\w+)", r"\1%%%", prose))]
    got = by_id(quality.judge(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: r["kept"] for i, r in got.items()} == {1: True, 2: True, 3: False, 4: False}
    assert got[2]["clean_text"] == prose


def test_licenses(spark, empty):
    for odd in ("(a and b) with x", "a with (b and c)", "a with b with c", "a with", "with a"):
        assert licenses.parse(odd) is None
    assert licenses.parse("a with (x) with " * 40 + "b") is None
    assert licenses.evaluate(licenses.parse(" and ".join(["mit", "isc with x"] * 20_000)))[1] == 40_000
    assert licenses.parse("MIT OR (Apache-2.0 AND GPL-2.0 WITH x)") == ["mit", "apache-2.0", "gpl-2.0", "x", "with", "and", "or"]
    assert licenses.evaluate(licenses.parse("a and b or c")) == (["a", "b", "c"], 1)
    assert [licenses.parse(x) for x in ("", "or", "(a", "a b", "a)", "a or", "()")] == [None] * 7
    rows = [
        (1, "X. MIT License; the mit-license MIT license! SPDX-License-Identifier: MIT OR Apache-2.0\nmore"),
        (2, "GNU General Public License, version 3"),
        (3, None),
        (4, "transmit license"),
        (5, "mit license mit license apache license"),
    ]
    got = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    show = lambda i: tuple(got[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
    assert show(1) == (17, 3, 1, 6, "mit", "apache-2.0,mit", 1.0)
    assert show(2) == (6, 1, 1, 1, "gpl", "gpl,gpl-3.0", 0.9)
    assert show(3) == (0, 0, None, None, "", "", 0.0)
    assert show(4) == (2, 0, None, None, "", "", 0.0)
    assert show(5) == (6, 3, 0, 4, "apache,mit", "apache,mit", 0.6)
    assert licenses.scan(empty).count() == 0


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[k] += items[i]
            go(i + 1, bins)
            bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_dominance_keeps_an_optimum():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.choice([10, 13, 20, 31])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        counts = np.bincount(np.array(items, int), minlength=capacity + 1)
        left = counts.copy()
        fixed = packing.reduce_by_dominance(left, capacity)
        assert sum(n for _, n in fixed) + fewest(np.repeat(np.arange(capacity + 1), left).tolist(), capacity) == fewest(items, capacity)
        used = left + sum((n * np.bincount([k for k, e in runs for _ in range(e)], minlength=capacity + 1) for runs, n in fixed), np.zeros_like(left))
        assert (used == counts).all()
        assert packing.plan(counts, capacity)[1] <= fewest(items, capacity) + 1


def least_sequences(lengths, capacity):
    """Lower bound L2: lengths over half need a sequence each, and the small ones must fit beside them."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone = sum(x > capacity - k for x in lengths)
        half = [x for x in lengths if capacity / 2 < x <= capacity - k]
        room = sum(capacity - x for x in half)
        small = sum(x for x in lengths if k <= x <= capacity / 2)
        best = max(best, alone + len(half) + max(0, math.ceil((small - room) / capacity)))
    return best


def test_packing(docs, texts, empty):
    reader = Tokenizer.from_file(WORDS)
    reader.encode_special_tokens = True
    rows = packing.pack(docs, WORDS, capacity=64).collect()
    expected = {}
    for i, text in enumerate(texts):
        ids = np.array([*reader.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 64)):
            expected[i, piece] = (start, len(ids[start : start + 64]), zlib.crc32(ids[start : start + 64].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= least_sequences([r["length"] for r in rows], 64) + 1
    assert packing.pack(empty, WORDS).count() == 0


def test_bpe(docs, texts, empty):
    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(3)
    strange = ["".join(rng.choice("ab \n\t\r\x1c\x85　é1'sl!́漢") for _ in range(50)) for _ in range(300)] + ["a" * 3000, "ab" * 2000]
    for text in [*strange, *(t or "" for t in texts)]:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode_ordinary(text)
        assert own.decode(ids) == text.encode()
    long = ["ab é" * 30_000 + "z" * 5000, " " * 4000, "\n", " x" * 700]
    for batch in (strange + long, [t or "" for t in texts], [], [""]):  # words side by side in one queue, and stores that are full
        for keep in (10**6, 20):
            own.chunks.remember = own.parts.remember = keep
            encoded = own.encode_all(batch)
            assert [ids.tolist() for ids in encoded] == [whole.encode_ordinary(text) for text in batch]
            assert own.decode_all(encoded) == [text.encode() for text in batch]
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 30))) for _ in range(3000)] + ["aaaaaaaaa", "abababab", "é" * 9]
    ids, sizes = own.merge_together([w.encode() for w in words])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [own.merge(w.encode()) for w in words]
    got = by_id(bpe.digest(docs, RANKS, public_tokenizers.PATTERN))
    for i, text in enumerate(t or "" for t in texts):
        ids = np.array(whole.encode_ordinary(text), "<u4").tobytes()
        assert got[i]["n_tokens"] == len(ids) // 4
        assert got[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert bpe.decode(encoded.withColumnRenamed("decoded", "whole"), RANKS, public_tokenizers.PATTERN).where("decoded <> whole").count() == 0
    assert bpe.digest(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_language_model(docs, texts, empty):
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in enumerate(texts) if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for head in (lm.HEAD, 20):  # with 20, most words meet their counts by the join
        got = by_id(lm.score(docs, head=head))
        for i, t in enumerate(texts):
            r = got[i]
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(tokens(t)), sum(w in counts for w in tokens(t)), n)
            assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert lm.score(empty).count() == 0


def test_log_bilinear_is_normalised_and_learns():
    c = np.resize(np.arange(4), 4000)  # 0 1 2 3 0 1 2 3 ...
    b, a = np.roll(c, 1), np.roll(c, 2)
    model = lm.LogBilinear(classes=4, dimensions=8)
    model.fit(a, b, c, np.ones(len(c)), steps=200)
    table = model.table()
    assert np.allclose((10.0**table).sum(axis=2), 1, atol=1e-4)
    assert table[2, 3, 0] > np.log10(0.8)


def test_language_model_beats_counts_on_held_out_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = lm.score(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held["s"] > held["b"]


def test_chat(spark):
    rows = [
        (1, 0, "system", "Be kind.", 1),
        (1, 1, "ann", "Hi", 1),
        (1, 2, "bob", None, 1),
        (1, 2, "bob", None, 1),
        (1, 70, "ann", "Bye", 1),
        (2, 0, "system", "Alone.", 1),
        (None, None, None, "?", 1),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block int")
    got = {(r["conv_id"], r["perspective"], r["block"]): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (None, "unnamed", None)}
    r = got[1, "ann", 0]
    assert r["rendered"] == "<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi<|end|>\n<|user name=bob|>\n<|end|>\n"
    start, stop = map(int, r["mask"].split(":"))
    assert r["rendered"][start:stop] == "Hi<|end|>" and r["n_trained"] == 9 and r["n_turns"] == 3
    assert got[1, "bob", 1]["mask"] == "" and got[1, "bob", 1]["n_trained"] == 0
    assert chat.rotate(df.limit(0)).count() == 0


def test_queries_against_their_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name, text in ORACLES.items():
        cursor = con.execute(text)
        names = [d[0] for d in cursor.description]
        want = sorted(cursor.fetchall())
        assert want and sorted(tuple(r) for r in QUERIES[name](spark, sf).select(*names).collect()) == want, name
