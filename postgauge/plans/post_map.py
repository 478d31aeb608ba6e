"""Questions on a map, ready to be shown and labelled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.functions.posts import answered_flag, display_text
from postgauge.operators.annotate import with_store
from postgauge.operators.lookup import fits
from postgauge.operators.matching import questions
from postgauge.operators.projection import project
from postgauge.session import materialise
from postgauge.stages.post_features import PostFeatures

SHOWN = ["Title", "Body", "Score", "Tags", "AnswerCount"]
AXES = ["x", "y", "z"]
# Points that are sent to the texts, instead of the texts to them.
BROADCAST_POINTS = 2_000_000


def post_map(
    df: DataFrame, features: PostFeatures, shown: list[str] = SHOWN, n_components: int = 2, method: str = "neighbors"
) -> DataFrame:
    """Questions with their coordinates, `cluster`, display text and an empty label store.

    The first three coordinates are `x`, `y` and `z`, further ones `x3`, `x4` and so on. Up to
    `BROADCAST_POINTS` points, by a count, no text moves.
    """
    q = questions(df)
    row_id = features.getOrDefault("idCol")
    # Fitting, the layout and its centre all read these rows; the texts are read once.
    prepared = materialise(features.prepare(q).select(row_id, *features.inputs()))
    vectors = features.fit(prepared).transform(prepared)
    at = project(vectors, "features", row_id, n_components, method)
    names = [*AXES, *(f"x{i}" for i in range(len(AXES), n_components))][:n_components]
    points = materialise(at.select(row_id, *[F.get("coordinates", F.lit(i)).alias(n) for i, n in enumerate(names)]))
    flagged = q.withColumn("cluster", answered_flag())
    readable = flagged.withColumns({c: display_text(c) for c in shown if c in q.columns})
    return with_store(readable.join(F.broadcast(points) if fits(points, BROADCAST_POINTS) else points, row_id))
