"""Manual labels: edits merged into one JSON object per row, and unpacked again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions.text import strip
from postgauge.operators.lookup import fits

STORE = "label_store"
MAP = "map<string,string>"
# Label keys a broadcast registry may hold.
REGISTRY_ROWS = 100_000
# Label keys that may become columns.
MAX_KEYS = 1000


def init_store(c: str = STORE) -> Column:
    """Anything that is not JSON object text becomes the empty object."""
    return F.when(F.startswith(F.col(c), F.lit("{")), F.col(c)).otherwise("{}")


def with_store(df: DataFrame, store: str = STORE) -> DataFrame:
    return df.withColumn(store, init_store(store) if store in df.columns else F.lit("{}"))


def store_map(c: str = STORE) -> Column:
    """The object as a map; broken JSON reads as empty."""
    return F.coalesce(F.from_json(init_store(c), MAP), F.create_map().cast(MAP))


def raw_map(c: str = STORE) -> Column:
    """The object as a map of JSON values with their types; broken JSON reads as empty.

    Objects with a value that repeats a key inside itself are read as text values.
    """
    as_text = F.transform_values(store_map(c), lambda k, v: v.cast("variant"))
    return F.coalesce(F.from_json(init_store(c), "map<string,variant>"), as_text)


def tidy_key(c: Column) -> Column:
    """Trimmed, first letter upper, rest lower."""
    key = strip(c)
    return F.concat(F.upper(F.left(key, F.lit(1))), F.lower(F.substr(key, F.lit(2))))


def canonical_keys(edits: DataFrame, registry: DataFrame, key: str = "key") -> DataFrame:
    """Edits with tidy keys; a registered key differing only by case wins, empty is refused.

    `registry` has one column, `key`.
    """
    known = registry.groupBy(F.lower("key").alias("folded")).agg(F.min("key").alias("registered"))
    if fits(known, REGISTRY_ROWS):
        known = F.broadcast(known)
    wanted = edits.withColumn("folded", F.lower(strip(F.col(key)))).where(F.col("folded") != "")
    return (
        wanted.join(known, "folded", "left")
        .withColumn(key, F.coalesce("registered", tidy_key(F.col(key))))
        .drop("folded", "registered")
    )


def latest_labels(edits: DataFrame, row_id: str = "Id", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The last value per row and key; empty values are refused. Hot rows shrink map-side."""
    valid = edits.where((F.col("value") != "") & (strip(F.col("key")) != ""))
    return valid.groupBy(row_id, "key").agg(F.max_by("value", F.struct(*order)).alias("value"))


def apply_labels(df: DataFrame, edits: DataFrame, row_id: str = "Id", store: str = STORE) -> DataFrame:
    """Rows with their store updated by the edits; rows without edits keep theirs as they are.

    Values that no edit replaces keep their JSON types.
    """
    value = F.col("value").cast("variant").alias("value")
    fresh = latest_labels(edits, row_id).groupBy(row_id).agg(
        F.map_from_entries(F.collect_list(F.struct("key", value))).alias("fresh")
    )
    old = F.col("old")
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(F.col("fresh"), k)), F.col("fresh"))
    return (
        with_store(df, store)
        .withColumn("old", raw_map(store))
        .join(fresh, row_id, "left")
        .withColumn(store, F.when(F.col("fresh").isNull(), F.col(store)).otherwise(F.to_json(merged)))
        .drop("old", "fresh")
    )


def label_keys(df: DataFrame, store: str = STORE, configured: list[str] = fixed.LABEL_KEYS) -> DataFrame:
    """Keys in use and configured ones, sorted without regard to case."""
    used = df.select(F.explode(F.map_keys(store_map(store))).alias("key"))
    extra = df.sparkSession.createDataFrame([(k,) for k in configured], "key string")
    return used.union(extra).distinct().orderBy(F.lower("key"), "key")


def expand_labels(
    df: DataFrame, store: str = STORE, keys: list[str] | None = None, empty: str | None = None
) -> DataFrame:
    """One column per key, null (or `empty`) where a row has none.

    Keys in use are looked up if not given; as they become columns, more than `MAX_KEYS` are
    refused, and so are keys that name a column already there, whatever their case.
    """
    if keys is None:
        keys = [r["key"] for r in label_keys(df, store, []).limit(MAX_KEYS + 1).collect()]
    names = [name.lower() for name in [*df.columns, *keys]]
    clashes = sorted({k for k in keys if names.count(k.lower()) > 1})
    if len(keys) > MAX_KEYS or clashes:
        raise ValueError(f"label keys can't become columns: {clashes[:5] or f'more than {MAX_KEYS}'}")
    labels = store_map(store)
    return df.withColumns({k: F.coalesce(F.try_element_at(labels, F.lit(k)), F.lit(empty)) for k in keys})


def single_label(
    df: DataFrame, edits: DataFrame, row_id: str = "Id", column: str = "new_label", order: tuple[str, ...] = ("ts", "event_id")
) -> DataFrame:
    """One label per row: the last edit, else what was there, else the default."""
    last = edits.groupBy(row_id).agg(F.max_by("value", F.struct(*order)).alias("edited"))
    before = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return (
        df.join(last, row_id, "left")
        .withColumn(column, F.coalesce("edited", before, F.lit(fixed.UNLABELED)))
        .drop("edited")
    )
