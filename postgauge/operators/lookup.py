"""Word lookups: exploded tokens joined to a reference table of words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.session import materialise

BROADCAST_ROWS = 1_000_000
HEAVY = 10_000  # a word is heavy if it fills more than one in so many tokens; so there are fewer than that


def fits(table: DataFrame, max_rows: int) -> bool:
    """Whether the table has at most max_rows rows; stops counting just beyond."""
    return table.limit(max_rows + 1).count() <= max_rows


def heavy_words(tokens: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """The words that fill more than one in `heavy` tokens, stored; fewer than `heavy`."""
    counts = materialise(tokens.where(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return materialise(counts.where(F.col("n") * F.lit(heavy) > F.lit(total)).select("word"))


def lookup_words(
    tokens: DataFrame,
    table: DataFrame,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    heavy: int = HEAVY,
) -> DataFrame:
    """Join tokens (any columns plus `word`) to a table with one row per `word`.

    A counted-small table is broadcast, so tokens never move. Of a larger one only the rows of
    heavy words are: those words, known or not, stay where they are. The others are counted per
    row of the other columns and shuffled, so no task gets more than one in `heavy` tokens for a word.
    The result carries `uses`, the number of tokens a row stands for.
    """
    one = F.lit(1).cast("bigint").alias("uses")
    if fits(table, max_rows):
        return tokens.select("*", one).join(F.broadcast(table), "word", how)
    often = heavy_words(tokens, heavy)
    known = materialise(table.join(F.broadcast(often), "word", "left_semi"))
    # The broadcasts hold fewer than `heavy` rows, whatever the sizes of tokens and table.
    stay = tokens.join(F.broadcast(often), "word", "left_semi")
    if how == "left":
        stay = stay.unionByName(tokens.where(F.col("word").isNull()))
    move = tokens.where(F.col("word").isNotNull()).join(F.broadcast(often), "word", "left_anti")
    counted = move.groupBy(*tokens.columns).agg(F.count(F.lit(1)).alias("uses"))
    # A large table may still look small to the optimiser: what moves is joined by its words.
    shuffled = counted.join(table.hint("merge"), "word", how)
    return stay.select("*", one).join(F.broadcast(known), "word", how).unionByName(shuffled)
