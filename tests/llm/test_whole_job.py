"""Inputs on which an operator once did less than its whole job."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from tapeline.llm import exact_dedup, packing, quality, suffix_dedup

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_packing_keeps_the_tokenizers_own_marks(spark):
    reader = Tokenizer.from_file(WORDS)
    marked = ["hello <|endoftext|> world <|startoftext|>x", "a<|endoftext|>É!<|endoftext|> 漢<|startoftext|>0\nB", "<|endoftext|>"]
    texts = [*marked, "<|EndOfText|> is no mark", "<|ENDOFTEXT|> 漢", "a <|endoftext |> b", "Hello WORLD."]
    assert reader.encode(texts[0], add_special_tokens=False).ids == [3306, 49407, 1002, 49406, 343]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORDS).collect()
    for r in rows:
        ids = np.array([*reader.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1], "<u4")
        assert (r["length"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes())), texts[r["doc_id"]]
    assert len(rows) == len(texts)


def test_suffix_dedup_tells_reaches_apart_that_share_32_bits(spark):
    # around this block, which is the anchor of all windows here, these contexts agree in the upper half of their hash
    block, part = "2bdaeb08eac115284b1823ba4c734c949c498237", lambda s: hashlib.sha256(s.encode()).hexdigest()[:60]
    pairs = [(23403, 80096), (19971, 100706), (27241, 100821), (24896, 106738), (54269, 115194), (118844, 147523)]
    rows = [(i, part(f"l{i}") + block + part(f"r{i}")) for pair in pairs for i in pair]
    got = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 12 and {r["n_removed"] for r in got} == {0}


def test_pipeline_quality_keeps_quoted_phrases_and_long_lines(spark):
    prose = [
        "Il dit « bonjour » puis « merci » et sortit de la maison sans attendre.",
        "« Il est parti. »",
        "Er sagte »gut« und »schlecht« zugleich, und niemand widersprach ihm an diesem Abend.",
        "The firm holds a larger market share on this coast than any of its rivals had held before.",
        "Each catalog in the library was copied by hand, and the copies were kept in another town for safety.",
        "My grandmother gave each of us a cookie and sent us out to play until supper was ready.",
        " ".join(f"Cook{i} gave{i} guest{i} a cookie at{i} noon{i}." for i in range(30)),
        "The table was set as a | b in the first draft and as a | c in the second one, which the editor liked better.",
    ]
    junk = [
        "Home | News | About us.",
        "Home » News » Weather today.",
        " | ".join(f"Item {i}" for i in range(40)) + ".",
        "Welcome to the shop. |",
        "All rights reserved.",
        "We use cookies!",
        "Read more. Sign up. Log in. Subscribe. Back to top. Click here. Privacy policy.",
    ]
    rows = [(i, line) for i, line in enumerate(prose + junk)]
    lines = spark.createDataFrame(rows, "doc_id long, text string")
    failing = {r["doc_id"] for r in lines.where(quality.junk_line(lines["text"])).collect()}
    assert failing == set(range(len(prose), len(rows)))
    docs = spark.createDataFrame([(1, "\n".join(prose + junk), 0)], "doc_id long, text string, n_chars long")
    kept = corpus_pipeline.quality_rules(spark, docs, "").collect()
    assert [r["text"] for r in kept] == ["\n".join(prose)]


def test_drop_copies_leaves_one_row_of_each_text(spark):
    rows = [(4, "same"), (4, "same"), (2, "same"), (None, "lost"), (None, "lost"), (None, "lost"), (7, None), (7, ""), (9, "own"), (None, "alone")]
    left = exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r["text"] or "", r["doc_id"] or -1) for r in left) == [("", 7), ("alone", -1), ("lost", -1), ("own", 9), ("same", 4)]
