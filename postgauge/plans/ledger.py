"""A record of finished stages, so that a run that was cut short goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "stage string, digest string, path string, seconds double, finished string"


def table_digest(df: DataFrame) -> str:
    """A digest of a table's rows in any order: their number and the sum of their hashes.

    One pass in which every task sends one row. Column names and types count; repeated rows count as often.
    """
    columns = sorted(df.columns)
    shown = [F.coalesce(F.to_json(F.struct(F.col(f"`{c}`"))), F.lit("")) for c in columns]
    row = F.xxhash64(*shown).cast("decimal(38,0)")
    n, total = df.agg(F.count(F.lit(1)), F.sum(row)).first()
    types = [(c, df.schema[c].dataType.simpleString()) for c in columns]
    return digest_of(types, int(n), str(total))


def digest_of(*parts) -> str:
    """A digest of plain values; one that has none of its own counts by its text."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


class Ledger:
    """Stages of a run in `folder`, which all executors can reach.

    A stage writes below a path of its own name and digest. It is recorded, as a one-row table, once
    it has returned: what a lost driver leaves half written has no record and is written anew.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.done: list[tuple] = []

    def _recorded(self, stage: str, digest: str) -> tuple | None:
        try:
            return self.spark.read.schema(ROW).parquet(f"{self.folder}/ledger/{stage}-{digest}").first()
        except AnalysisException:  # no such path
            return None

    def stage(self, name: str, digest: str, work: Callable[[str], None]) -> str:
        """The path that holds the stage's results, made now or earlier from the same input."""
        row = self._recorded(name, digest)
        if row is None:
            path, start = f"{self.folder}/{name}-{digest}", time.time()
            work(path)
            row = (name, digest, path, time.time() - start, datetime.now(timezone.utc).isoformat())
            self.spark.createDataFrame([row], ROW).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ledger/{name}-{digest}")
        self.done.append(tuple(row))
        return row[2]

    def rows(self) -> DataFrame:
        """The stages that this run went through, in their order."""
        return self.spark.createDataFrame([(k, *r) for k, r in enumerate(self.done)], f"step int, {ROW}")
