"""The registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import bpe, chat, exact_dedup, licenses, lm, merkle, online_packing, packing, quality, sharding, simhash, suffix_dedup, trie
from tapeline.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_copies(docs).select("doc_id", "fingerprint", "component_id", "representative")


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars")
    return quality.judge(docs).select(*columns)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op11_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    changed = F.when(crc % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.leaf_digest(*[changed if c == "text" else F.col(c) for c in merkle.FIELDS])
    out = merkle.manifest(table(spark, sf_dir, "documents"), extra={"found": found})
    out = out.withColumn("proof_sha256", merkle.proof_digest(F.col("proof"))).withColumn("folded_root", merkle.fold(F.col("found"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(trie.ordered_turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_simhash": op3_simhash,
    "op4_chat_rotation": op4_chat_rotation,
    "op5_kd_shards": op5_kd_shards,
    "op6_line_rules": op6_line_rules,
    "op7_license_scan": op7_license_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_log_bilinear": op10_log_bilinear,
    "op11_online_packing": op11_online_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}
