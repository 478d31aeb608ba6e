"""Score and length distributions of questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions.posts import numeric
from postgauge.operators.matching import questions
from postgauge.operators.quantiles import exact_median, exact_quantiles
from postgauge.session import materialise

GROUPS = ["low", "high"]
SERIES = ["Score", "BodyLength"]


def score_split(df: DataFrame, body_limit: int = fixed.BODY_LENGTH_LIMIT) -> DataFrame:
    """Short questions in a low group, up to the median score, and a high one."""
    # Several passes follow, here and in the caller: the bodies are measured once.
    short = materialise(
        questions(df)
        .select("Id", numeric("Score").alias("Score"), F.length("Body").alias("BodyLength"))
        .where(F.col("BodyLength") < body_limit)
    )
    median = exact_median(short, F.col("Score"))
    return short.withColumn(
        "score_group",
        F.when(F.col("Score") <= F.lit(median), "low").when(F.col("Score") > F.lit(median), "high"),
    ).where(F.col("score_group").isNotNull())


def iqr_filter(df: DataFrame, group: str = "score_group", factor: float = 1.5) -> DataFrame:
    """Cells beyond the quartiles by more than factor times their distance become null; rows stay."""
    series = {
        f"{g}_{s}": F.when(F.col(group) == g, F.col(s)) for g in GROUPS for s in SERIES
    }
    quartiles = exact_quantiles(df, series, [0.25, 0.75])

    def keep(s: str):
        cell = F.lit(None).cast("double")
        for g in GROUPS:
            q1, q3 = quartiles[f"{g}_{s}"]
            if q1 is not None:
                margin = factor * (q3 - q1)
                cell = F.when(
                    (F.col(group) == g) & F.col(s).between(q1 - margin, q3 + margin), F.col(s).cast("double")
                ).otherwise(cell)
        return cell

    return df.withColumns({s: keep(s) for s in SERIES})


def length_histogram(df: DataFrame, group: str = "score_group", bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Density per group, series and bin over the group's common range; empty bins included."""
    ends = df.groupBy(group).agg(
        F.min(F.least(*SERIES)).alias("low"),
        F.max(F.greatest(*SERIES)).alias("high"),
        *[F.count(s).alias(f"n_{s}") for s in SERIES],
    )
    # A single value gets a range of width one around it.
    flat = F.col("low") == F.col("high")
    ends = ends.select(
        group,
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        F.explode(F.array(*[F.struct(F.lit(s).alias("series"), F.col(f"n_{s}").alias("n")) for s in SERIES])).alias("s"),
    ).select(group, "low", "high", "s.series", "s.n")
    cells = df.select(
        group, F.explode(F.array(*[F.struct(F.lit(s).alias("series"), F.col(s).alias("x")) for s in SERIES])).alias("c")
    ).select(group, "c.series", "c.x")
    # Two groups by two series: four rows to broadcast.
    binned = (
        cells.where(F.col("x").isNotNull())
        .join(F.broadcast(ends), [group, "series"])
        .withColumn("bin", F.least(F.floor((F.col("x") - F.col("low")) * bins / (F.col("high") - F.col("low"))), F.lit(bins - 1)).cast("int"))
        .groupBy(group, "series", "bin")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("high") - F.col("low")) / bins
    rows = F.coalesce("rows", F.lit(0))
    return grid.join(binned, [group, "series", "bin"], "left").select(
        group,
        "series",
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        rows.alias("rows"),
        (rows / (F.col("n") * width)).alias("density"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values as text, sorted."""
    return df.select(F.col(column).cast("string").alias(column)).distinct().orderBy(column)
