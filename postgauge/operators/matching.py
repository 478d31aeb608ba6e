"""Questions, answers and who answers what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.functions.posts import ANSWER, QUESTION


def questions(df: DataFrame) -> DataFrame:
    return df.where(F.col("PostTypeId") == QUESTION)


def answers(df: DataFrame) -> DataFrame:
    return df.where(F.col("PostTypeId") == ANSWER)


def answered_ids(df: DataFrame) -> DataFrame:
    """Ids with at least one answer, reduced before any join: one row per question."""
    return answers(df).where(F.col("ParentId").isNotNull()).select(F.col("ParentId").alias("Id")).distinct()


def match_questions_answers(df: DataFrame) -> DataFrame:
    """Every question with every answer to it.

    The question side has one row per key; a question with very many answers makes a
    skewed partition on the answer side only, which adaptive execution splits.
    """
    q = questions(df).select(F.col("Id").alias("QuestionId"), F.col("Body").alias("QuestionBody"))
    a = answers(df).select(
        F.col("ParentId").alias("QuestionId"), F.col("Id").alias("AnswerId"), F.col("Body").alias("AnswerBody")
    )
    return q.join(a, "QuestionId").select("QuestionId", "QuestionBody", "AnswerId", "AnswerBody")


def unanswered_questions(df: DataFrame) -> DataFrame:
    return questions(df).join(answered_ids(df), "Id", "left_anti")


def answered_questions(df: DataFrame) -> DataFrame:
    return questions(df).join(answered_ids(df), "Id", "left_semi")


def qa_counts(df: DataFrame) -> DataFrame:
    """Unanswered, accepted and answered questions, in one row."""
    q = questions(df).select("Id", "AcceptedAnswerId")
    hit = answered_ids(df).withColumn("hit", F.lit(True))
    return q.join(hit, "Id", "left").agg(
        F.count_if(F.col("hit").isNull()).alias("unanswered"),
        F.count_if(F.col("AcceptedAnswerId").isNotNull()).alias("accepted"),
        F.count_if(F.col("hit")).alias("answered"),
    )
