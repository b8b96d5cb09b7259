"""The corpus pipeline: raw documents to packed training sequences.

Stages, in order: quality classifier (rejected documents go), MinHash
near-duplicates (one document of each group stays), benchmark decontamination
(documents that hold a benchmark window go), secret scan (secrets are masked in
the text), packing (the token pieces of every document and their sequences).
Each stage works on all its predecessor kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from limelight.llm import common, decontamination, neardup, packing, quality, secrets


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.7; the model is fitted on the labelled rows of the documents given.

    Where these hold no two classes, no model is fitted and all documents stay.
    """
    common.ready(spark)
    model = quality.train(docs, common.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, threshold=0.7)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    common.ready(spark)
    return neardup.keep_one(docs, n=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten benchmark words."""
    common.ready(spark)
    return decontamination.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in the text and n_chars following it."""
    common.ready(spark)
    return secrets.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    common.ready(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

# SQL can express neither the trained classifier nor the tokenizer; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder and read again."""
    folder = f"{common.shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
