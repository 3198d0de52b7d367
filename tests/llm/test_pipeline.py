"""Every stage of the corpus pipeline against a plain version, on the rows that its predecessor kept."""

from __future__ import annotations

import corpus_pipeline

from tapeline.llm import quality
from tests.llm.test_text_operators import brute_print, brute_spans, components


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == columns
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).where("kept").collect()
    assert kept[0] == {r["doc_id"]: r["clean_text"] for r in judged}
    last = {}
    for i, t in sorted(kept[0].items()):
        last[t] = i
    assert set(kept[1]) == set(last.values())
    ids = sorted(kept[1])
    prints = [brute_print(kept[1][i]) for i in ids]
    near = [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert set(kept[2]) == {ids[c] for c in components(len(ids), near)}
    ids = sorted(kept[2])
    spans = brute_spans([kept[2][i].encode() for i in ids], 100)
    for i, own in zip(ids, spans):
        data, left, at = kept[2][i].encode(), "", 0
        for a, b in own:
            left, at = left + data[at:a].decode(errors="ignore"), b
        left += data[at:].decode(errors="ignore")
        assert kept[3].get(i, "") == left
    assert {r["doc_id"] for r in docs.collect()} == set(kept[3])


def test_run_gives_what_the_stages_give(spark, sf):
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
