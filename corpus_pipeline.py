"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.  All but the
last return the columns of their input; the last returns the ids, their number, and the decoded text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import latent, near_copies, pieces, skip_chain, toxicity
from tidelog.llm.common import forget, table
from tidelog.session import scratch_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the compression distance does not reject.

    The model learns from the labelled ones among ``docs``, but for the fifth that is held out.
    """
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group whose texts share 80 % of their five-word shingles."""
    return near_copies.without_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item."""
    return latent.clean(docs, latent.indexes(docs, table(spark, sf_dir, "benchmark")))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and puts a mark such as [EMAIL] for every span of personal data.

    n_chars, where there is such a column, follows the new text.
    """
    out = skip_chain.redacted(docs, skip_chain.fit(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text")).cast(kind))
    return out


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text, their number, and the text that the ids decode to."""
    return pieces.encode(docs, keep=["doc_id"], outputs=("ids", "n_tokens", "decoded"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

#: SQL cannot express the stages; tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet to the shared folder and read again."""
    folder = scratch_folder(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            forget(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
