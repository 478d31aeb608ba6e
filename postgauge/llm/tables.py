"""What the operators of this folder share: reading, spreading and storing tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.session import fresh_path, materialise

__all__ = ["fresh_path", "map_beside", "materialise", "open_folder", "read", "shuffle_width", "small", "small_batches"]

BROADCAST_ROWS = 1_000_000  # of narrow rows: a few ids or numbers
BATCH_BYTES = 4 << 20  # of texts that a task hands to Python at once

Work = Callable[[list[pa.Array]], list[pa.Array]]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shuffle_width(spark: SparkSession, weight: float = 1.0) -> int:
    """Partitions for an explicit repartitioning: what the session gives to its shuffles."""
    return max(1, math.ceil(weight * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))


def small(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of narrow rows, marked for broadcast if a count proves it small.

    Beyond the bound the join shuffles both sides, and adaptive execution splits hot keys.
    """
    return F.broadcast(stored) if stored.limit(rows + 1).count() <= rows else stored


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path behind a URI, on the driver or in a task."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)


def small_batches(docs: DataFrame) -> DataFrame:
    """The same rows; from now on the session hands Python at most about `BATCH_BYTES` at once.

    Ten thousand texts, the default, may be any number of bytes, and are held several times
    over: by the JVM on the way out and back, by Arrow, and as Python objects.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs


def map_beside(
    docs: DataFrame, inputs: Sequence[Column], start: Callable[[], Work], schema: str, carry: Sequence[str] | None = None
) -> DataFrame:
    """Python work over Arrow batches that returns its results beside the rows they belong to.

    `start` runs once a task and gives the function that turns the arrays of `inputs` into
    those of `schema`. The result holds the struct `row` (all columns of `docs`, or those in
    `carry`), which no name of a result can clash with, and then the results.
    """
    kept = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)] or [F.lit(0).alias("none")]
    given = small_batches(docs).select(F.struct(*kept).alias("row"), *[c.alias(f"_{k}") for k, c in enumerate(inputs)])
    results = T._parse_datatype_string(schema)
    names = ["row", *results.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            arrays = work([batch.column(k) for k in range(1, batch.num_columns)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    return given.mapInArrow(run, T.StructType([given.schema["row"], *results.fields]))
