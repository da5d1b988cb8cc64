"""Registered queries of the subpackage, with SQL where SQL can express them.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (attention_lm, exact_dedup, hard_negatives, mixing, packing, quality, simhash, substring_dedup, token_frames,
               url_rules, viterbi, whitening, winnowing)
from .common import table
from .encode import tokenizer_path


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_edits(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix_sources(table(spark, sf_dir, "documents"))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_frames.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 0)
    return token_frames.read_token_files(manifest)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_winnowing": op1_winnowing,
    "op2_mixing": op2_mixing,
    "op3_attention_lm": op3_attention_lm,
    "op4_url_rules": op4_url_rules,
    "op5_simhash": op5_simhash,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_token_frames": op9_token_frames,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op4_url_rules": url_rules.URL_SQL,
    "op8_exact_dedup": exact_dedup.EXACT_SQL,
    "op11_hard_negatives": hard_negatives.NEGATIVE_SQL,
}
