"""From raw documents to packed sequences: five stages, each one operator of shelfline.llm.

Each stage takes the rows that its predecessor kept, as Parquet, and returns the columns of `documents`; the last one
returns pieces of sequences. What each does with nulls, empty or long texts, repeated rows and empty tables is said
in its operator's module.

SQL can't express the stages, so ORACLE_SQL is None; tests/llm/test_corpus_pipeline.py holds each of them against a
brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import chunks, kneser_ney, packing, rules, simhash
from shelfline.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like trusted text of their language."""
    return kneser_ney.keep_fluent(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules together take to be good."""
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (SimHash of three-word shingles, at most two bits apart)."""
    return simhash.keep_first(docs)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has, their lengths counted anew."""
    left = chunks.drop_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    import public_tokenizers

    return packing.digests(packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("substring duplicates", substring_duplicates),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
