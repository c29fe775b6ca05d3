"""A corpus from raw documents to packed training sequences: five stages, each reading what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import near_dedup, packing, pii, quality_knn, quality_rules
from seriesmill.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the nearest labelled documents vote for, each judged by its own text: a doc_id may be null or have several
    texts, and repeated rows stay or go together. Null and empty texts get the share of label 1 among the learned
    documents. An empty table stays empty. Columns beyond those of documents are dropped."""
    found = quality_knn.scored(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return found.where("predicted = 1").select(COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the current policy, each judged by its own text, whatever its doc_id; null and empty texts have too
    few words and go. An empty table stays empty. Columns beyond those of documents are dropped."""
    found = quality_rules.judged(docs, keep=COLUMNS)
    return found.where("kept").select(COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the least doc_id, nulls last, and of the least md5 among its texts. Of
    repeated rows one stays, with the least of their other columns. Rows are told apart by doc_id and text, so a
    copy takes no other text of its doc_id with it. An empty table stays empty."""
    return near_dedup.one_of_each(docs, COLUMNS)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced by its kind and n_chars counted anew; null texts stay null. Nulls in other
    columns, repeated rows and repeated doc_ids stay as they are; an empty table stays empty."""
    found = pii.detected(docs, keep=COLUMNS, with_redacted=True)
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.length("redacted").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of a fixed length, with the token ids of each piece, row by row: a null text is one end token, a
    repeated row is packed as often as it occurs. An empty table gives no pieces."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [("quality classifier", quality), ("quality rules", rules), ("near-dedup", dedup), ("PII", privacy), ("packing", pack)]

#: Classifier, sketches, random field and tokenizer cannot be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
