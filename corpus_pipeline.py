"""The corpus pipeline: documents to packed sequences in five stages.

Each stage is a function of (spark, docs, sf_dir). Its result is written as
Parquet and read again as the documents of the next one, so a stage never
computes its predecessors anew. All stages but the last return the columns of
``documents``; the last returns a row per packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clinicflow.llm import dart_minhash, line_dedup, packing, quality_classifier, quality_rules
from clinicflow.llm.common import table, written


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts; documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the classifier, learnt from the labelled documents of ``sf_dir``, doesn't accept."""
    return quality_classifier.keep_accepted(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that nearly repeat an earlier line of any document go; documents left without words go."""
    return line_dedup.remove_duplicate_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return dart_minhash.keep_one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the tokenized documents, each with its place in a sequence."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), keep_words=False))


STAGES = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: Training, similarity classes and packing can't be said in SQL; tests/llm/test_pipeline.py compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
