"""The seven quality features of a titled post."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions import text as T
from postgauge.operators.textstats import readability


def row_features(title: str = "Title", body: str = "Body") -> dict:
    """The six features that need nothing but the row itself."""
    return {
        "title_len": F.length(T.text(title)),
        "body_len": F.length(T.text(body)),
        "title_ends_with_qmark": T.contains_question_mark(title),
        "body_ends_with_qmark": T.contains_question_mark(body),
        "action_verbs_density": T.action_density(body),
        "title_caps_ratio": T.caps_ratio(title),
    }


def quality_features(
    df: DataFrame, lexicon: DataFrame, row_id: str = "Id", title: str = "Title", body: str = "Body"
) -> DataFrame:
    """Row id and the seven features, one row per post; ids must be unique.

    Text is read once and never shuffled: each post leaves its partition as one row of
    small numbers.
    """
    cheap = row_features(title, body)
    small = df.withColumns(cheap)
    scored = readability(small, T.concat_text(title, body), row_id, lexicon, *cheap)
    return scored.select(row_id, *fixed.QUALITY_FEATURES)
