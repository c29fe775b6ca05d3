"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import (bpe, conversation_repair, filter_audit, fingerprints, line_dedup, lm_scoring, near_dedup, packing, pii, quality_knn,
                            quality_rules, sql, toxicity, warc)
from seriesmill.llm.common import table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# The others are held against brute force in tests/llm.
ORACLES = {"op1_rules": sql.RULES, "op2_near_dedup": sql.NEAR, "op7_warc": sql.ARCHIVED, "op11_filter_audit": sql.AUDIT,
           "op12_line_dedup": sql.LINES}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coded(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), keep_text=False)


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), least=0)


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_knn.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detected(table(spark, sf_dir, "documents"))


@query
def op1_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        "failed_bits", "policy")


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(table(spark, sf_dir, "documents"), width=3, percent=85)


@query
def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversation_repair.repaired(conversation_repair.damaged(rows), rows, with_text=False)
    return found.withColumnRenamed("repaired", "repaired_sha256")
