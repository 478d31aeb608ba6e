"""Binary classification measures, all from one small count table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions.text import ratio


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction) cell, all four cells present."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("label"),
                    F.lit(p).alias("prediction"),
                    F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias("n"),
                )
                for a, p in cells
            ]
        ).alias("cells")
    )
    return counts.select(F.inline("cells"))


def _scores(hit: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    precision, recall = ratio(hit, predicted), ratio(hit, actual)
    return {"precision": precision, "recall": recall, "f1_score": ratio(2 * precision * recall, precision + recall)}


def _class_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: correct rows, all rows, and per class hits, predictions and members."""
    y, p = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if(y == p).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        *[F.count_if((y == c) & (p == c)).alias(f"hit{c}") for c in (0, 1)],
        *[F.count_if(p == c).alias(f"predicted{c}") for c in (0, 1)],
        *[F.count_if(y == c).alias(f"actual{c}") for c in (0, 1)],
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; an empty denominator gives 0."""
    return _class_counts(df, label, prediction).select(
        ratio(F.col("correct"), F.col("total")).alias("accuracy"),
        *[c.alias(n) for n, c in _scores(F.col("hit1"), F.col("predicted1"), F.col("actual1")).items()],
    )


CLASS_NAMES = {0: "Low Quality", 1: "High Quality"}


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class scores with support, then accuracy, macro and weighted averages."""
    counts = _class_counts(df, label, prediction)
    per = {c: _scores(F.col(f"hit{c}"), F.col(f"predicted{c}"), F.col(f"actual{c}")) for c in (0, 1)}
    names = ["precision", "recall", "f1_score"]

    def row(name: str, values: list[Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), *[v.cast("double").alias(n) for n, v in zip(names, values)], support.alias("support")
        )

    accuracy = ratio(F.col("correct"), F.col("total"))
    macro = [(per[0][n] + per[1][n]) / 2 for n in names]
    weighted = [
        ratio(per[0][n] * F.col("actual0") + per[1][n] * F.col("actual1"), F.col("total")) for n in names
    ]
    rows = [row(CLASS_NAMES[c], [per[c][n] for n in names], F.col(f"actual{c}")) for c in (0, 1)]
    rows.append(row("accuracy", [accuracy] * 3, F.col("total")))
    rows.append(row("macro avg", macro, F.col("total")))
    rows.append(row("weighted avg", weighted, F.col("total")))
    return counts.select(F.inline(F.array(*rows)))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows over classes times rows of the class."""
    from pyspark.sql import Window as W

    every = W.partitionBy()  # one row per class
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("weight", F.sum("n").over(every) / (F.count("n").over(every) * F.col("n")))
