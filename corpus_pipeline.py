"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, suffix-array dedup, best-fit packing.

Each stage takes what its predecessor kept, as Parquet, and its decisions take effect. All but
the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from tapeline.llm.common import delete, packed, recorded, table
from tapeline.staging import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
#: The packing stage shares its Python workers with other stages, so it holds less than the operator alone and nothing between tasks.
WORDS_HELD, SLICE_HELD = 100_000, 1_000_000

_of_last_stage: list[str] = []


def _with_text(row: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """The struct `row` as columns, with `text` as its text and n_chars counted anew."""
    whole = F.col("row").withField("text", F.col(text))
    if "n_chars" in columns:
        whole = whole.withField("n_chars", F.char_length(text).cast("long"))
    return row.select(whole.alias("row")).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their failing lines."""
    judged = quality.judge(packed(docs, "text"), fails=quality.junk_line)
    # a plain filter would be pushed below the verdict and compute it twice
    verdict = F.struct("row", "clean_text", "kept")
    one = judged.select(F.explode_outer(F.filter(F.array(verdict), lambda v: v["kept"])).alias("v")).where("v IS NOT NULL")
    return _with_text(one.select("v.*"), "clean_text", docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the bytes that a string of 100 bytes repeats; documents that lose all go."""
    cut = suffix_dedup.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), remember=WORDS_HELD, keep=False, slice_bytes=SLICE_HELD)


def _alone(stage: Stage) -> Stage:
    """The stage, after the intermediates of the one before it are deleted: its output has been written by then."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete(spark, _of_last_stage)
        with recorded(_of_last_stage):
            return stage(spark, docs, sf_dir)

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _alone(quality_rules)),
    ("exact_dedup", _alone(exact_copies)),
    ("simhash_near_dedup", _alone(near_copies)),
    ("suffix_dedup", _alone(repeated_passages)),
    ("best_fit_packing", _alone(sequences)),
]

#: Suffixes, SimHash and tokenizers are not SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        delete(spark, last)
        last = [path]
    return docs
