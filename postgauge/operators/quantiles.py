"""Exact quantiles with bounded memory."""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.session import materialise

# Distinct values the driver may hold at once.
MAX_DISTINCT = 100_000
# Parts into which one round cuts a bracket.
BUCKETS = 1024
LARGEST = sys.float_info.max

Target = tuple[int, int]  # number of a column, 0-based rank


def _clean(c: Column) -> Column:
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probabilities: list[float],
    max_distinct: int = MAX_DISTINCT,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per named column; None where a column is all null.

    The input is read once, to count its values; all ranks are then found together in the
    stored counts.
    """
    counts = value_counts(df, list(columns.values()))
    sizes = {r["column"]: r["rows"] for r in counts.groupBy("column").agg(F.sum("n").alias("rows")).collect()}
    places = {(k, p): (n - 1) * p for k, n in sizes.items() for p in probabilities}
    ranks = {(k, end(place)) for (k, _), place in places.items() for end in (math.floor, math.ceil)}
    found = order_statistics(counts, ranks, max_distinct)

    def at(k: int, p: float) -> float | None:
        if k not in sizes:
            return None
        place = places[k, p]
        low, high = found[k, math.floor(place)], found[k, math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {name: [at(k, p) for p in probabilities] for k, name in enumerate(columns)}


def exact_median(df: DataFrame, column: Column) -> float | None:
    return exact_quantiles(df, {"x": column}, [0.5])["x"][0]


def value_counts(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Stored rows (column, x, n): how often a column, named by its number, holds a value.

    Null and NaN are left out. Rows are counted before they move, so a value that fills a
    third of a column is a row for each task that read it.
    """
    cells = F.array(*[F.struct(F.lit(k).alias("column"), _clean(c).alias("x")) for k, c in enumerate(columns)])
    values = df.select(F.explode(cells).alias("cell")).select("cell.column", "cell.x").where(F.col("x").isNotNull())
    return materialise(values.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n")))


def _bucket(low: float, high: float) -> Column:
    """The part of [low, high] that holds `x`; rises with x."""
    low, high = max(low, -LARGEST) / 2, min(high, LARGEST) / 2  # halves, as the difference may overflow
    x = F.least(F.greatest(F.col("x"), F.lit(-LARGEST)), F.lit(LARGEST)) / 2
    part = F.floor(F.try_divide(x - F.lit(low), F.lit(high - low)) * BUCKETS)
    return F.coalesce(F.least(part, F.lit(BUCKETS - 1)), F.lit(0))


def order_statistics(counts: DataFrame, ranks: set[Target], max_distinct: int = MAX_DISTINCT) -> dict[Target, float]:
    """The values at 0-based ranks of columns, from their `value_counts`.

    A round cuts the brackets around all ranks into buckets and counts these in one job; the
    bucket that holds a rank, from its least to its largest value, is the rank's next bracket.
    Once the brackets hold few distinct values these are read.
    """
    found: dict[Target, float] = {}
    brackets: dict[Target, tuple[float, float, int, int]] = {}  # low, high, rows below, distinct values

    def narrow(target: Target, low: float, high: float, below: int, distinct: int) -> None:
        if low == high:
            found[target] = low
            brackets.pop(target, None)
        else:
            brackets[target] = low, high, below, distinct

    ends = counts.groupBy("column").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("d"))
    for r in ends.collect():
        for target in ranks:
            if target[0] == r["column"]:
                narrow(target, r["low"], r["high"], 0, r["d"])
    while brackets:
        sizes = {(column, low, high): d for (column, _), (low, high, _, d) in brackets.items()}
        order = sorted(sizes)
        last = sum(sizes.values()) <= max_distinct
        which = bucket = F.lit(None)
        for k, (column, low, high) in enumerate(order):
            inside = (F.col("column") == column) & F.col("x").between(low, high)
            which = F.when(inside, F.lit(k)).otherwise(which)
            bucket = F.when(inside, F.col("x") if last else _bucket(low, high)).otherwise(bucket)
        rows = counts.select(which.alias("which"), bucket.alias("bucket"), "x", "n").where(F.col("which").isNotNull())
        parts = rows.groupBy("which", "bucket").agg(
            F.sum("n").alias("n"), F.count("x").alias("d"), F.min("x").alias("low"), F.max("x").alias("high")
        )
        read: list[list] = [[] for _ in order]
        for r in parts.collect():  # BUCKETS rows a bracket, or `max_distinct` in all
            read[r["which"]].append(r)
        for k, key in enumerate(order):
            held = sorted(read[k], key=lambda r: r["bucket"])
            upto = [0, *accumulate(r["n"] for r in held)]
            for target, (low, high, below, _) in list(brackets.items()):
                if (target[0], low, high) == key:
                    i = bisect_right(upto, target[1] - below) - 1
                    narrow(target, held[i]["low"], held[i]["high"], below + upto[i], held[i]["d"])
    return found
