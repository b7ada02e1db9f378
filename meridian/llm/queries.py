"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meridian.llm import chat, cost_packing, decontamination, divergence, lines, mixing, packing, quality, repair, simhash, suffixes, token_counts, toxicity
from meridian.llm.common import table


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
        " AS t(conv_id, turn, role, text)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.chat_windows(turns, public_tokenizers.path("word_bpe_49k.json")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(conversations), conversations)


def op13_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cost_packing.pieces_of(cost_packing.pack_balanced(docs, public_tokenizers.path("byte_bpe_50k.json")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = {
        f.__name__: f
        for f in (
            op1_chat_windows,
            op2_line_dedup,
            op3_mix_sources,
            op4_suffix_dedup,
            op5_pack_tokens,
            op6_toxicity,
            op7_quality_rules,
            op8_decontamination,
            op9_simhash_dedup,
            op10_token_counts,
            op11_source_audit,
            op12_conversation_repair,
            op13_cost_packing,
        )
    }
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {op11_source_audit.__name__: divergence.SQL}
