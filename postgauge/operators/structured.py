"""Fitted transforms of numeric, categorical and date columns.

Each `fit_*` returns small plain values; the matching `apply`-side is a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions.posts import numeric
from postgauge.operators.quantiles import exact_quantiles


def _number(c: str) -> Column:
    x = numeric(c)
    return F.when(~F.isnan(x), x)


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact training medians."""
    found = exact_quantiles(df, {c: numeric(c) for c in columns}, [0.5])
    empty = [c for c in columns if found[c][0] is None]
    if empty:
        raise ValueError(f"no value to take a median of: {empty}")
    return {c: found[c][0] for c in columns}


def impute(c: str, median: float) -> Column:
    return F.coalesce(_number(c), F.lit(median))


def fit_scales(df: DataFrame, columns: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, in one pass."""
    row = df.select(*[c.cast("double").alias(name) for name, c in columns.items()]).agg(
        *[F.avg(name).alias(f"m_{name}") for name in columns],
        *[F.stddev_pop(name).alias(f"s_{name}") for name in columns],
    ).first()
    return {name: (row[f"m_{name}"] or 0.0, row[f"s_{name}"] or 0.0) for name in columns}


def scale(c: Column, mean: float, deviation: float) -> Column:
    """Standardised value; a constant column becomes 0."""
    return (c.cast("double") - F.lit(mean)) / F.lit(deviation or 1.0)


def category(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(fixed.MISSING_CATEGORY))


def fit_categories(df: DataFrame, column: str, limit: int = fixed.MAX_CATEGORIES) -> tuple[list[str], bool]:
    """Kept categories in name order, and whether an infrequent slot exists.

    Beyond `limit` categories the limit - 1 most frequent stay; among equal counts the
    later name wins. Only limit + 1 rows reach the driver.
    """
    top = (
        df.groupBy(category(column).alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.desc("name"))
        .limit(limit + 1)
        .collect()
    )
    infrequent = len(top) > limit
    return sorted(r["name"] for r in (top[: limit - 1] if infrequent else top)), infrequent


def one_hot(column: str, kept: list[str], infrequent: bool) -> dict[str, Column]:
    """One 0/1 column per kept category; unseen values go to the infrequent slot, if any."""
    value = category(column)
    slots = {f"{column}_{name}": (value == name).cast("double") for name in kept}
    if infrequent:
        slots[f"{column}_{fixed.INFREQUENT_SUFFIX}"] = (~value.isin(*kept)).cast("double")
    return slots


def date_parts(df: DataFrame, column: str) -> dict[str, Column]:
    """Year, month and day of a date; text that is no date gives null."""
    when = F.col(column)
    if df.schema[column].dataType.typeName() == "string":
        when = when.try_cast("timestamp")
    return {f"{column}_year": F.year(when), f"{column}_month": F.month(when), f"{column}_day": F.dayofmonth(when)}


def extract_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Date columns replaced by their parts."""
    for c in columns:
        df = df.withColumns(date_parts(df, c)).drop(c)
    return df
