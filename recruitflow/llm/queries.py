"""The registered queries of the operators: thin views of each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_repair,
    decontamination,
    importance,
    minhash,
    mixing,
    packing,
    permutation_index,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from .common import SPACE_CLASS, new_folder, read

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *quality_rules.COUNTS, "n_upper", "n_marks", "n_stop_words", "n_lines",
                      "base_failed", "kept")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.allocations(read(spark, sf_dir, "documents"), carry=["doc_id"])
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.neighbours(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score_keys(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.filter(F.split("kept_text", SPACE_CLASS), lambda w: w != "")
    return got.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.array_join(words, " ").cast("binary"), 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.remove_strings(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(read(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontamination.contamination(docs, read(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(conversation_repair.damaged(read(spark, sf_dir, "conversations")))


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_warc, op3_mixing, op4_permutation_index, op5_toxicity, op6_substring_dedup, op7_packing,
        op8_suffix_dedup, op9_token_counts, op10_minhash, op11_decontamination, op12_importance, op13_conversation_repair)}
