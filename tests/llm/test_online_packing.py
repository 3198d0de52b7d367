"""Online packing: every id in one piece, no gap in a sequence, nothing padded; and the word store against the whole tokenizer."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tapeline.llm import online_packing
from tapeline.llm.online_packing import Packer
from tapeline.llm.words import WordTokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start int, ids string, task string"
ODD = [
    None, "", " ", "\n\n", "x" * 5000, "Hello WORLD.", "hello <|endoftext|> world <|startoftext|>x", "a<|endoftext|>É!<|endoftext|> 漢<|startoftext|>0\nB",
    "<|EndOfText|> is no mark", "J̌ ǰ İ İ ΣΑΣ ß 's don't x's 12a a12 ab!!c d...e 0 00 100", "a\tb c　d", "</w> </w></w> <w/> w>", "!!! ,;. é. É", "the end. " * 4000,
]


@pytest.fixture(scope="module")
def reader():
    return Tokenizer.from_file(WORDS)


def texts():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéö") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    return ODD + [" ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "!)"]) for _ in range(rng.randint(0, 900))) for _ in range(90)]


def check(rows, given, reader, capacity):
    """Rows against the ids of the texts `given` (id, text); ids need not be unique."""
    whole = []
    for doc, text in given:
        whole.append((doc, np.array([*reader.encode(text or "", add_special_tokens=False).ids, 1], "<u4")))
    if len({doc for doc, _ in given}) == len(given):
        own = dict(whole)
        pieces = {}
        for r in rows:
            pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        assert set(pieces) == set(own)
        for doc, parts in pieces.items():
            at = 0
            for start, length, crc, tokens in sorted(parts):
                assert (start, tokens) == (at, len(own[doc])) and length > 0
                assert crc == zlib.crc32(own[doc][start : start + length].tobytes())
                at += length
            assert at == len(own[doc])
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    lengths = Counter()
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths[at] += 1
    total = sum(len(ids) for _, ids in whole)
    rest = total % capacity
    assert lengths[capacity] == total // capacity
    assert {n: m for n, m in lengths.items() if n != capacity and m} == {1 << b: 1 for b in range(rest.bit_length()) if rest >> b & 1}


@pytest.mark.parametrize(("capacity", "windows", "parts", "group"), [(2048, 64, 7, 2), (128, 3, 5, 16), (2048, 64, 1, 16)])
def test_pack(spark, reader, capacity, windows, parts, group):
    given = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in given], SCHEMA).repartition(parts)
    rows = online_packing.pack(df, WORDS, capacity=capacity, windows=windows, group=group).collect()
    check(rows, given, reader, capacity)


def test_repeated_and_null_ids(spark, reader):
    given = [(None, "a b"), (None, "a b"), (3, "x " * 3000), (3, "x " * 3000), (4, None)] * 5
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    rows = online_packing.pack(df, WORDS).collect()
    check(rows, given, reader, 2048)
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == {None: 10, 3: 10, 4: 5}
    assert online_packing.pack(df.limit(0), WORDS).count() == 0


def test_space_is_bounded_and_few_are_cut():
    rng, out = random.Random(1), []
    packer = Packer(100, 5, out.append)
    for i in range(3000):
        packer.add(i, np.zeros(rng.randint(1, 60), np.uint32), 0)
        assert len(packer.open) <= 5 and sum(map(len, packer.held.values())) <= 500
    packer.leftover()
    assert all(sum(len(ids) for _, _, ids, _ in window) == 100 for window in out)
    assert sum(start > 0 for window in out for _, start, _, _ in window) <= len(out)


def test_words(reader):
    given = [t or "" for t in texts()]
    small, large = WordTokenizer(WORDS, remember=40), WordTokenizer(WORDS)
    for tokenizer in (small, large):
        for at in range(0, len(given), 13):
            for text, ids in zip(given[at : at + 13], tokenizer.encode(given[at : at + 13])):
                assert ids.tolist() == reader.encode(text, add_special_tokens=False).ids
    assert large.encode([]) == [] and [len(x) for x in large.encode(["", " "])] == [0, 0]
    large.forget(10)
    assert len(large.known.place) <= 10 and max(map(len, large.known.place)) <= 48
