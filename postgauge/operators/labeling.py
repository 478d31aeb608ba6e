"""Rule and median labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.functions.posts import numeric, quality_label, score_above
from postgauge.operators.quantiles import exact_median

OPTIONAL = ["ClosedDate", "AcceptedAnswerId"]


def with_optional_columns(df: DataFrame) -> DataFrame:
    """Collections without closed dates or accepted ids read them as null."""
    return df.withColumns({c: F.lit(None).cast("string") for c in OPTIONAL if c not in df.columns})


def with_quality_label(df: DataFrame, label: str = "label") -> DataFrame:
    return with_optional_columns(df).withColumn(label, quality_label())


def labeled_training_set(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows the rules are sure about, without the score they were judged by."""
    return with_quality_label(df, label).where(F.col(label) != -1).drop("Score")


def score_median(df: DataFrame, score: str = "Score") -> float | None:
    return exact_median(df, numeric(score))


def median_labeled_set(
    df: DataFrame, threshold: float | None = None, label: str = "label"
) -> tuple[DataFrame, float | None]:
    """All rows, labelled by score above the threshold or, without one, the median."""
    if threshold is None:
        threshold = score_median(df)
    labeled = df.withColumn(label, score_above(threshold) if threshold is not None else F.lit(False))
    return labeled.drop("Score"), threshold


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per label. The window runs over one row per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


def label_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Total, excluded and kept rows, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == -1).alias("excluded"),
        F.count_if(F.col(label) != -1).alias("kept"),
    )
