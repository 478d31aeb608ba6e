"""Corpus text statistics: one pass over exploded tokens, one row per text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions import text as T
from postgauge.operators.lookup import lookup_words


def tokens(df: DataFrame, text: str, row_id: str, *keep: str) -> DataFrame:
    """One row per token; a text without tokens keeps one row with a null token."""
    return df.select(row_id, *keep, F.explode_outer(T.word_tokens(T.text(text))).alias("token"))


def sentence_tokens(df: DataFrame, text: str, row_id: str) -> DataFrame:
    """One row per sentence with its token list."""
    return df.select(
        row_id, F.posexplode(T.split_sentences(T.text(text))).alias("sentence_no", "sentence")
    ).select(row_id, "sentence_no", T.word_tokens(F.col("sentence")).alias("tokens"))


def with_syllables(tokens: DataFrame, lexicon: DataFrame, token: str = "token") -> DataFrame:
    """Add `uses`, `alphabetic` and `syllables` to exploded tokens.

    Known words take the lexicon's count, other alphabetic tokens one, the rest none.
    """
    keyed = tokens.withColumn("word", F.lower(token)).withColumn(
        "alphabetic", F.coalesce(T.is_alphabetic(F.col(token)), F.lit(False))
    )
    found = lookup_words(keyed, lexicon.select("word", "syl"))
    return found.withColumn(
        "syllables",
        F.when(F.col("syl").isNotNull(), F.col("syl")).when(F.col("alphabetic"), 1).otherwise(0),
    )


def syllable_count(df: DataFrame, text: str, row_id: str, lexicon: DataFrame) -> DataFrame:
    return (
        with_syllables(tokens(df, text, row_id), lexicon)
        .groupBy(row_id)
        .agg(F.sum(F.col("syllables") * F.col("uses")).alias("syllables"))
    )


def readability(df: DataFrame, text: Column, row_id: str, lexicon: DataFrame, *keep: str) -> DataFrame:
    """Sentences, words, syllables and Flesch score per text, by white-space tokens.

    `keep` names small columns that depend on the row id; they ride along instead of
    being joined back.
    """
    # Counted before the explode: beside it, the count would run once per token.
    counted = df.select(
        row_id, *keep, T.readability_sentences(text).alias("sentences"), T.readability_tokens(text).alias("tokens")
    )
    exploded = counted.select(row_id, *keep, "sentences", F.explode_outer("tokens").alias("token"))
    return (
        with_syllables(exploded, lexicon)
        .groupBy(row_id)
        .agg(
            *[F.max(c).alias(c) for c in [*keep, "sentences"]],
            F.sum(F.col("alphabetic").cast("bigint") * F.col("uses")).alias("words"),
            F.sum(F.col("syllables") * F.col("uses")).alias("syllables"),
        )
        .withColumn("flesch_score", T.flesch(F.col("sentences"), F.col("words"), F.col("syllables")))
    )


def text_report(df: DataFrame, text: str, row_id: str, lexicon: DataFrame) -> DataFrame:
    """Every statistic of a text in one row.

    What needs the text as a whole is taken before the explode; the rest are sums that
    collapse to one row per text before the only shuffle.
    """
    split = df.select(
        row_id, F.size(T.split_sentences(T.text(text))).alias("sentences"), T.word_tokens(T.text(text)).alias("tokens")
    )
    # Beside the explode this would run once per token.
    counted = split.select("*", F.size(F.array_distinct("tokens")).alias("distinct"))
    exploded = counted.select(row_id, "sentences", "distinct", F.explode_outer("tokens").alias("token"))
    uses = F.col("uses")

    def usage(words: list[str]) -> Column:
        return F.coalesce(F.sum(F.when(F.col("token").isin(*words), uses)), F.lit(0))

    sums = with_syllables(exploded, lexicon).groupBy(row_id).agg(
        usage(fixed.REPORTING_VERBS).alias("told_said"),
        usage(fixed.CONJUNCTIONS).alias("but_and"),
        usage(fixed.WH_ADVERBS).alias("wh_adverbs"),
        F.coalesce(F.sum(F.length("token") * uses), F.lit(0)).alias("characters"),
        F.coalesce(F.sum(F.when(F.col("token").isNotNull(), uses)), F.lit(0)).alias("tokens"),
        F.max("distinct").alias("distinct"),
        F.sum(F.col("syllables") * uses).alias("syllables"),
        F.sum(F.col("alphabetic").cast("bigint") * uses).alias("words"),
        F.max("sentences").alias("sentences"),
    )
    return sums.select(
        row_id,
        "told_said",
        "but_and",
        "wh_adverbs",
        T.ratio(F.col("characters"), F.col("tokens")).alias("mean_token_length"),
        T.ratio(F.col("distinct"), F.col("tokens")).alias("unique_fraction"),
        "syllables",
        "words",
        "sentences",
        T.flesch(F.col("sentences"), F.col("words"), F.col("syllables")).alias("flesch_score"),
    )
