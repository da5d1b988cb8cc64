"""The corpus pipeline: documents in, packed training sequences out.

Quality classifier, exact dedup, SimHash near-dedup, mixing of sources, best-fit
packing. Each stage is written as Parquet in the shared checkpoint folder and
reread, so a lost executor repeats part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenderlens.llm import exact_dedup, mixing, packing, quality, simhash
from tenderlens.llm.common import cut_lineage, table
from tenderlens.llm.encode import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the weak-label classifier scores as good."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    return simhash.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their target weights."""
    return mixing.draw_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every piece of every document in a sequence of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 1)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# classifier, SimHash, the knapsack and the packing are not expressible in SQL: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
