"""Abbreviations learned from a corpus, and sentences that don't end after them.

A word type that a full stop follows far more often than chance, for its length, is an abbreviation
(the collocational score of Kiss and Strunk, 2006). No list of any language is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions import text as T

CANDIDATE = r"\p{L}+(?:\.\p{L}+)*\.?"  # letters, also with stops inside, and perhaps a stop behind
THRESHOLD = 0.3
# Abbreviations that a splitter may hold; a table with more is refused.
MAX_WORDS = 10_000


def stop_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n, n_stop): lower-case word types, how often they occur and how often before a stop.

    One read of the texts; tasks count before anything moves.
    """
    found = df.select(F.explode(F.regexp_extract_all(T.text(text), F.lit(CANDIDATE), F.lit(0))).alias("token"))
    stop = F.endswith("token", F.lit("."))
    word = F.lower(F.when(stop, F.expr("left(token, length(token) - 1)")).otherwise(F.col("token")))
    return found.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"), F.count_if(stop).alias("n_stop"))


def abbreviations(counts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(word, n, n_stop, score) of the word types that score `threshold` or more.

    The score is the log likelihood ratio of "a stop follows it 99 times in 100" against "as often as any
    word", times the stops inside and one, over e to the letters, and over the letters to the
    power of the occurrences without a stop. `counts` is read twice: store it first.
    """
    totals = counts.agg((F.sum("n_stop") / F.sum("n")).alias("p"))  # one row
    k, rest = F.col("n_stop"), F.col("n") - F.col("n_stop")
    chance = k * F.ln("p") + rest * F.ln(1 - F.col("p"))
    bound = k * F.ln(F.lit(0.99)) + rest * F.ln(F.lit(0.01))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    inside = F.length("word") - letters
    score = 2 * (bound - chance) * (inside + 1) * F.exp(-letters) * F.pow(letters.cast("double"), -rest.cast("double"))
    some = counts.where("n_stop > 0").join(F.broadcast(totals.where("p < 1")))
    return some.select("word", "n", "n_stop", score.alias("score")).where(F.col("score") >= threshold)


def join_after(pieces: Column, words: list[str]) -> Column:
    """Sentences from pieces cut at every mark: one that ends in an abbreviation goes on in the next.

    Pieces that belong together are joined by one space.
    """
    last = lambda p: F.lower(F.regexp_extract(p, rf"({CANDIDATE[:-3]})\.$", 1))
    n = F.size(pieces)
    numbered = F.transform(pieces, lambda p, i: F.when(~last(p).isin(words) | (i == n - 1), i + 1))
    ends = F.filter(numbered, lambda i: i.isNotNull())
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.greatest(F.size(ends) - 1, F.lit(0))))
    joined = F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(pieces, a + 1, b - a), " "))
    return F.when(n > 0, joined).otherwise(pieces)


def split_sentences(df: DataFrame, text: str, row_id: str, known: DataFrame) -> DataFrame:
    """(row id, sentence_no, sentence), with sentences that go on after the abbreviations `known` (`word`).

    Null and blank texts have no sentences.
    """
    words = [r["word"] for r in known.select("word").distinct().limit(MAX_WORDS + 1).collect()]
    if len(words) > MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS} abbreviations")
    pieces = df.select(row_id, T.split_sentences(T.text(text)).alias("pieces"))
    whole = join_after(F.col("pieces"), sorted(words)) if words else F.col("pieces")
    return pieces.select(row_id, F.posexplode(whole).alias("sentence_no", "sentence"))
