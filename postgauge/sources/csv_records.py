"""CSV records with quoted line breaks, from files that Spark may cut anywhere.

A line begins inside quotes if an odd number of quote marks comes before it in its file. So marks
are counted for every block of a file, a running sum over the blocks of a file tells which blocks
begin inside quotes, and every block then finds its own records. What hangs over the ends of
blocks, at most two pieces for each, is put together afterwards.

This holds for files in which a field with a quote mark is quoted and its marks are doubled, as Spark
and others write them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEAD, TAIL, RECORD = 0, 1, 2  # the end of a record begun before the block; its beginning; a whole one
PIECES = "block bigint, start bigint, kind int, text string, first boolean"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines in the order of their files, with the file and the block of it that a task reads."""
    lines = spark.read.option("lineSep", "\n").text(path)
    file = F.xxhash64("_metadata.file_path")
    return lines.select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _inside(lines: DataFrame) -> DataFrame:
    """Whether each block begins inside quotes: one row for every block of, say, 128 MB."""
    marks = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "start").agg(F.sum(marks).alias("marks"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    return blocks.select("file", "start", (F.coalesce(F.sum("marks").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Block:
    """The records of one block, batch after batch; lines of an open record wait for its end."""

    def __init__(self, file: int, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.at_head, self.first = inside, start == 0
        self.waiting: list[pa.Array] = []

    def _piece(self, kind: int) -> pa.RecordBatch:
        text = pc.binary_join(pa.ListArray.from_arrays([0, sum(map(len, self.waiting))], pa.concat_arrays(self.waiting)), "\n")
        self.waiting = []
        return self._batch(text, kind)

    def _batch(self, texts: pa.Array, kind: int) -> pa.RecordBatch:
        n = len(texts)
        first = np.zeros(n, bool)
        if n and kind == RECORD and self.first:
            first[0], self.first = True, False
        columns = [pa.array([v] * n, t) for v, t in ((self.file, pa.int64()), (self.start, pa.int64()), (kind, pa.int32()))]
        return pa.RecordBatch.from_arrays([*columns, texts, pa.array(first)], ["block", "start", "kind", "text", "first"])

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        after = np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + self.inside
        ends = np.flatnonzero(after % 2 == 0) + 1  # a record ends behind every line outside quotes
        self.inside = bool(after[-1] % 2)
        if not len(ends):
            self.waiting.append(lines)
            return
        if self.waiting or self.at_head:
            self.waiting.append(lines[: ends[0]])
            yield self._piece(HEAD if self.at_head else RECORD)
            self.at_head, lines, ends = False, lines[ends[0] :], ends[1:] - ends[0]
        if len(ends):
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield self._batch(pc.binary_join(pa.ListArray.from_arrays(offsets, lines[: ends[-1]]), "\n"), RECORD)
            lines = lines[ends[-1] :]
        if len(lines):
            self.waiting.append(lines)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:  # a block wholly inside quotes is the middle of a record, and has a head's place
            yield self._piece(HEAD if self.at_head else TAIL)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block: _Block | None = None
    for batch in batches:
        files, starts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        edges = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            if low == high:
                continue
            if block is None or (block.file, block.start) != (files[low], starts[low]):
                if block is not None:
                    yield from block.close()
                block = _Block(int(files[low]), int(starts[low]), batch.column(3)[low].as_py())
            yield from block.add(batch.column(0).slice(low, high - low))
    if block is not None:
        yield from block.close()


def csv_records(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """The records of CSV files, as `record`: one string each, without empty lines and, with
    `header`, without the first record of a file, which must end in its first block.

    Three passes over the files, each by as many tasks as they have blocks; lines aren't shuffled,
    only what crosses the end of a block.
    """
    lines = _lines(spark, path)
    # As many rows as blocks: some millions at most, of 17 bytes.
    known = lines.join(F.broadcast(_inside(lines)), ["file", "start"])
    pieces = known.select("value", "file", "start", "inside").mapInArrow(_cut, PIECES)
    whole = pieces.where(F.col("kind") == RECORD)
    if header:
        whole = whole.where(~F.col("first"))
    over = pieces.where(F.col("kind") != RECORD)
    # In a file's order every beginning opens a record, and what follows up to the next belongs to it.
    order = W.partitionBy("block").orderBy("start", "kind")
    opened = over.withColumn("n", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    parts = opened.groupBy("block", "n").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "text"))).alias("parts"))
    joined = parts.select(F.array_join("parts.text", "\n").alias("text"))
    return whole.select("text").unionByName(joined).where(F.btrim("text", F.lit(" \t\r")) != "").select(F.rtrim("text", F.lit("\r")).alias("record"))
