"""Splits that keep every author on one side, and repeatable samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.operators.lookup import fits
from postgauge.operators.quantiles import order_statistics, value_counts

# Hash digits used as a number: 13 hex digits are exact in a double.
DIGITS = 13


def seeded_hash(seed: int, key: str | Column) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _as_number(digest: Column) -> Column:
    return F.conv(F.substr(digest, F.lit(1), F.lit(DIGITS)), 16, 10).cast("double")


def fill_missing_groups(df: DataFrame, group: str = "OwnerUserId", row_id: str = "Id") -> DataFrame:
    """A row without a group becomes a group of its own.

    Its name comes from its id or, without one, from all of its columns; rows without group and
    id that are alike in all columns are one group, and no row is without.
    """
    if group not in df.columns:
        raise KeyError(f"no column '{group}' to split by")
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x1e")) for c in sorted(df.columns)]
    name = F.coalesce(F.col(row_id).cast("string"), F.md5(F.concat_ws("\x1f", *shown)))
    own = F.concat(F.lit("unknown_"), name)
    return df.withColumn(group, F.coalesce(F.col(group).cast("string"), own))


def split_by_group(
    df: DataFrame,
    group: str = "OwnerUserId",
    row_id: str = "Id",
    train_share: float = fixed.TRAIN_SHARE,
    seed: int = fixed.SEED,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; a group is never on both sides.

    A group's side depends only on its seeded hash, so nothing is shuffled, all rows
    of a large group agree, and new data does not move old groups; the share of
    groups on the train side is close to the one asked for. `exact` puts exactly
    floor(share * groups) there, at the price of one pass to count the groups.
    """
    rows = fill_missing_groups(df, group, row_id)
    digest = seeded_hash(seed, group)
    if exact:
        hashes = value_counts(rows.select(F.col(group)).distinct(), [_as_number(digest)])
        wanted = math.floor(train_share * (hashes.agg(F.sum("n")).first()[0] or 0))
        if wanted == 0:
            train = F.lit(False)
        else:
            last = (0, wanted - 1)
            train = _as_number(digest) <= F.lit(order_statistics(hashes, {last})[last])
    else:
        train = digest < f"{min(int(train_share * 16**8), 16**8 - 1):08x}" if train_share < 1 else F.lit(True)
    return rows.where(train), rows.where(~train)


def group_overlap(train: DataFrame, test: DataFrame, group: str = "OwnerUserId") -> DataFrame:
    """Groups on both sides; a correct split has none."""
    return train.select(group).intersect(test.select(group))


def first_rows(df: DataFrame, n: int, row_id: str, *order: Column) -> DataFrame:
    """The first n rows in an order of their ids; only ids are ranked, then n rows are fetched.

    With repeated ids more than n rows may be fetched, of which n stay.
    """
    first = df.select(row_id).orderBy(*order).limit(n).select(F.col(row_id).alias("_first"))
    kept = df.join(F.broadcast(first), F.col(row_id).eqNullSafe(F.col("_first")), "left_semi")
    return kept.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int = fixed.SAMPLE_SIZE, seed: int = fixed.SEED, row_id: str = "Id") -> DataFrame:
    """Exactly n rows, the same ones every time; asking for more than there are raises."""
    if n > 0 and fits(df.select(row_id), n - 1):
        raise ValueError(f"cannot take a sample of {n} rows from fewer")
    return first_rows(df, n, row_id, seeded_hash(seed, row_id), F.col(row_id))
