"""Manual labels as a table of buckets, into which edits are merged bucket by bucket.

A label is a row (row id, key, value as JSON text, ts, event_id, place), kept in the bucket that a hash of
its row id names. A merge reads and writes only buckets that its edits fall into; a new manifest, which
names every bucket's folder, then takes the place of the old one. It is written last, as one file, so
that readers and a merge that is cut short disturb nobody; what it names is never changed. The last
edit of a key wins by (ts, event_id), whichever merge brought it: late edits, and edits merged
twice, do no harm. One merge of a table runs at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.functions.text import strip
from postgauge.operators import annotate
from postgauge.session import materialise

MANIFEST = "bucket int, folder string, version int"
ORDER = ("ts", "event_id", "place")


class LabelTable:
    """Labels in `folder`, which all executors can reach. Opened anew, give the same `buckets`.

    A bucket with edits is written as a whole, by one task: choose as many as make it some 100 MB.
    """

    def __init__(self, spark: SparkSession, folder: str, row_id: str = "Id", buckets: int = 256):
        self.spark, self.folder, self.row_id, self.buckets = spark, folder.rstrip("/"), row_id, buckets

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """The folder of every bucket that holds labels, in a version or the last one."""
        version = self.version() if version is None else version
        if not version:
            return {}
        rows = self._manifests().where(F.col("version") == version).collect()
        if {r["bucket"] for r in rows} - set(range(self.buckets)):
            raise ValueError(f"the table in {self.folder} has more than {self.buckets} buckets")
        return {r["bucket"]: r["folder"] for r in rows}

    def version(self) -> int:
        """The last version; 0 if nothing was merged yet."""
        try:
            return self._manifests().agg(F.max("version")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def _manifests(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifests")

    def add_stores(self, df: DataFrame, store: str = annotate.STORE) -> int:
        """Merge the JSON stores of rows; they count as older than every edit with a time.

        Of a key that a store holds twice the later one stays; rows without id are left out.
        """
        entries = df.select(self.row_id, F.posexplode(F.map_entries(annotate.raw_map(store))).alias("place", "e"))
        none = F.lit(None).cast("bigint")
        return self._merge(
            entries.select(self.row_id, "e.key", F.to_json("e.value").alias("value"), none.alias("ts"), none.alias("event_id"), "place")
        )

    def merge(self, edits: DataFrame) -> int:
        """Merge edits (row id, key, value, ts, event_id) and give the version that holds them.

        Empty keys and values are refused, and edits without row id. Times are kept as numbers.
        """
        valid = edits.where((F.col("value") != "") & (strip(F.col("key")) != ""))
        is_time = edits.schema["ts"].dataType.typeName().startswith("timestamp")
        ts = F.unix_micros(F.col("ts").cast("timestamp")) if is_time else F.col("ts").cast("bigint")
        value = F.to_json(F.col("value").cast("variant")).alias("value")
        event_id, place = F.col("event_id").cast("bigint").alias("event_id"), F.lit(0).alias("place")
        return self._merge(valid.select(self.row_id, "key", value, ts.alias("ts"), event_id, place))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.row_id), F.lit(self.buckets)).cast("int")

    def _last(self, labels: DataFrame, *by: str) -> DataFrame:
        """One row per key of a row; equal times are told apart by the value."""
        kept = F.max(F.struct(*ORDER, "value")).alias("last")
        return labels.groupBy(*by, self.row_id, "key").agg(kept).select(*by, self.row_id, "key", "last.*")

    def _merge(self, labels: DataFrame) -> int:
        known = labels.where(F.col(self.row_id).isNotNull() & F.col("value").isNotNull())
        fresh = materialise(self._last(known).withColumn("bucket", self._bucket()))
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())  # at most `buckets`
        version = self.version()
        if not touched:
            return version
        before = self.manifest(version)
        both = fresh
        if old := self._read(before, touched):
            both = fresh.unionByName(old.withColumn("bucket", self._bucket()))
        folder = f"data-{uuid.uuid4().hex}"
        # Grouped where the buckets were sent, so that rows move once.
        merged = self._last(both.repartition(len(touched), "bucket"), "bucket")
        merged.write.partitionBy("bucket").parquet(f"{self.folder}/{folder}")
        after = before | dict.fromkeys(touched, folder)
        rows = self.spark.createDataFrame(sorted(after.items()), "bucket int, folder string")
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifests/version={version + 1}")
        return version + 1

    def _read(self, manifest: dict[int, str], buckets: list[int]) -> DataFrame | None:
        paths = [f"{self.folder}/{manifest[b]}/bucket={b}" for b in buckets if b in manifest]
        return self.spark.read.parquet(*paths) if paths else None

    def labels(self, version: int | None = None) -> DataFrame:
        """(row id, key, value as JSON text, ts, event_id, place) of a version, or of the last one."""
        manifest = self.manifest(version)
        found = self._read(manifest, sorted(manifest))
        if found is None:
            raise ValueError(f"no labels in {self.folder}")
        return found

    def stores(self, store: str = annotate.STORE, version: int | None = None) -> DataFrame:
        """One JSON object per row with labels, keys in order; values keep their JSON types."""
        pairs = F.array_sort(F.collect_list(F.struct("key", "value")))
        members = F.transform(pairs, lambda p: F.concat(F.to_json(p["key"].cast("variant")), F.lit(":"), p["value"]))
        body = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
        return self.labels(version).groupBy(self.row_id).agg(body.alias(store))
