"""From raw documents to token ids in five stages, each an operator of the training-text package.

Rows with null or empty texts are rejected by the first stage; every stage accepts an empty table
and extra columns, and repeated rows end as one row after the third.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arborsync.llm import decontamination, jaccard_join, line_templates, quality_rules  # noqa: E402
from arborsync.llm.catalog import table, tokenizer_file  # noqa: E402
from arborsync.llm.sentencepiece_stream import Tokenizer  # noqa: E402
from arborsync.staging import stage  # noqa: E402


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.good(docs)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across texts are cut; the first text keeps them."""
    return _with_length(line_templates.deduplicate_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal and similar texts stays."""
    return jaccard_join.one_per_class(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that stand in a benchmark phrase are cut."""
    return _with_length(decontamination.clean(docs, table(spark, sf_dir, "benchmark")))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and lang where given, the number of pieces and their ids."""
    tokenizer = Tokenizer(spark, tokenizer_file("piece_bpe_32k.model"))
    kept = [c for c in ("doc_id", "source", "lang") if c in docs.columns]
    encoded = docs.select(*kept, "text").withColumn("ids", tokenizer.encode("text"))
    return encoded.select(*kept, F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_recurring_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", cut_benchmark_passages),
    ("SentencePiece encoding", encode_pieces),
]

# Line templates and piece ids cannot be written in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
