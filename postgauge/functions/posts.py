"""Column expressions over post attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions.text import strip, text

QUESTION, ANSWER = 1, 2


def numeric(c: str) -> Column:
    """The column as a double; what is not a number, NaN included, becomes null."""
    value = F.col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def group_key(c: str) -> Column:
    """The column as text, with the spelled-out missing markers read as null."""
    key = F.col(c).cast("string")
    return F.when(~key.isin("None", "nan"), key)


def is_blank(c: str) -> Column:
    return strip(text(c)) == ""


def quality_label(score: str = "Score", closed: str = "ClosedDate", accepted: str = "AcceptedAnswerId") -> Column:
    """1 high, 0 low, -1 uncertain; the first rule that holds decides."""
    s = numeric(score)
    return (
        F.when(F.col(closed).isNotNull(), 0)
        .when(s < 0, 0)
        .when(~is_blank(accepted) & (s >= fixed.ACCEPTED_MIN_SCORE), 1)
        .when(s >= fixed.HIGH_SCORE, 1)
        .when(s == 0, 0)
        .otherwise(-1)
    )


def score_above(threshold: float, score: str = "Score") -> Column:
    """Strictly above the threshold; a missing score is not."""
    return F.coalesce(numeric(score) > F.lit(threshold), F.lit(False))


def answered_flag(count: str = "AnswerCount") -> Column:
    return F.when(numeric(count) > 0, "Answered").otherwise("Unanswered")


def display_text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(f"No {c}"))
