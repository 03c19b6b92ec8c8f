"""The queries of this folder by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfline.llm import (
    brown,
    chat,
    chunks,
    kneser_ney,
    mixing,
    negatives,
    packing,
    permutations,
    pieces,
    repair,
    rules,
    separators,
    simhash,
)

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": chat.query,
    "op2_quality_classifier": kneser_ney.query,
    "op3_packing": packing.query,
    "op4_token_counts": separators.query,
    "op5_quality_rules": rules.query,
    "op6_nearest_neighbours": permutations.query,
    "op7_class_lm": brown.query,
    "op8_sentencepiece": pieces.query,
    "op9_simhash": simhash.query,
    "op10_substring_dedup": chunks.query,
    "op11_conversation_repair": repair.query,
    "op12_hard_negatives": negatives.query,
    "op13_source_mix": mixing.query,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLES: dict[str, str] = {
    "op1_chat_format": chat.ORACLE,
    "op11_conversation_repair": repair.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_source_mix": mixing.ORACLE,
}
