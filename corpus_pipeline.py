"""From raw documents to packed training sequences, one stored stage after the other."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.llm import decontaminate, near_dup, packing, secret_scan, toxicity
from postgauge.llm.tables import materialise, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learned from `labels` scores below one half."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies."""
    return near_dup.keep_one(docs, percent=80)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten benchmark words occurs."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and `n_chars`, if there is such a column, counted anew where there were any."""
    if "n_chars" not in docs.columns:
        return secret_scan.redact(docs)
    before = f"before_{uuid.uuid4().hex}"  # clashes with no column
    marked = secret_scan.redact(docs.withColumn(before, F.col("text")))
    n_chars = F.when(F.col("text") != F.col(before), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return marked.withColumn("n_chars", n_chars).drop(before)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their place in a sequence of 2048 tokens."""
    return packing.pack_documents(docs, 2048, public_tokenizers.path("word_bpe_49k.json"), end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Tokenizers, learned scores and a packing search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
