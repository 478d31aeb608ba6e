"""Post, lexicon, word-vector and label-event tables derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations read as questions (user turns) and answers (assistant turns).

    An answer's parent is the latest question before it. `Id` holds the turn in its
    last three digits, so a conversation, the only window partition here, has at
    most a thousand rows.
    """
    turns = table(spark, folder, "conversations").where(F.col("role").isin("user", "assistant"))
    earlier = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    c = turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("Id"),
        F.when(F.col("role") == "user", 1).otherwise(2).alias("PostTypeId"),
        "conv_id",
        "turn",
        F.col("text").alias("Body"),
    )
    last_question = F.max(F.when(F.col("PostTypeId") == 1, F.col("Id"))).over(earlier)
    p = c.withColumn("ParentId", F.when(F.col("PostTypeId") == 2, last_question))
    # Answers per question stay inside the conversation: same partitioning, no second shuffle.
    same_parent = W.partitionBy("conv_id", F.coalesce("ParentId", "Id"))
    is_answer = F.col("ParentId").isNotNull()
    p = p.withColumn("answers", F.count(F.when(is_answer, 1)).over(same_parent)).withColumn(
        "first_answer", F.min(F.when(is_answer, F.col("Id"))).over(same_parent)
    )
    question = F.col("PostTypeId") == 1
    return p.select(
        "Id",
        "PostTypeId",
        "ParentId",
        F.when(question, F.substr("Body", F.lit(1), F.lit(60))).alias("Title"),
        "Body",
        ((F.col("conv_id") * 7 + F.col("turn") * 13) % 17 - 3).cast("int").alias("Score"),
        F.when(F.col("conv_id") % 11 != 0, (F.col("conv_id") % 97).cast("string")).alias("OwnerUserId"),
        F.when(question & (F.col("conv_id") % 3 == 0), F.col("first_answer")).alias("AcceptedAnswerId"),
        F.when(question & (F.col("conv_id") % 13 == 0), "2024-01-01").alias("ClosedDate"),
        F.when(question, F.col("answers")).alias("AnswerCount"),
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


def documents_as_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as posts: the first line is the title, the whole text the body."""
    return documents(spark, folder).select(
        F.col("doc_id").alias("Id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("Title"),
        F.col("text").alias("Body"),
    )


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the benchmark with a syllable count: runs of vowels, at least one."""
    words = (
        table(spark, folder, "benchmark")
        .select(F.explode(F.regexp_extract_all(F.col("text"), F.lit("[A-Za-z]+"), F.lit(0))).alias("word"))
        .select(F.lower("word").alias("word"))
        .distinct()
    )
    return words.withColumn("syl", F.greatest(F.lit(1), F.regexp_count("word", F.lit("[aeiouy]+"))))


def word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The lexicon word of alphabetical rank i gets the embedding of id i.

    Ranks are counted per three-letter prefix and shifted by the words of the prefixes
    before; there are at most 26 + 26**2 + 26**3 prefixes, which bounds the running total.
    """
    words = lexicon(spark, folder).select("word", F.substr("word", F.lit(1), F.lit(3)).alias("prefix"))
    sizes = words.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("prefix").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("prefix", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(W.partitionBy("prefix").orderBy("word")) - 1
    ranked = (
        words.withColumn("within", within)
        .join(F.broadcast(starts), "prefix")
        .select("word", (F.col("start") + F.col("within")).alias("vec_id"))
    )
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return ranked.join(vectors, "vec_id").select("word", "vector")


def vector_width(spark: SparkSession, folder: str) -> int:
    return table(spark, folder, "embeddings").select(F.size("embedding")).first()[0]


def label_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as edits: the user is the row, the event type the key."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("Id"),
        "event_id",
        "ts",
        F.col("event_type").alias("key"),
        F.floor(F.col("value") * 100).cast("bigint").cast("string").alias("value"),
    )
