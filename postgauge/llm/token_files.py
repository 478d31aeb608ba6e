"""Token ids in binary files: frequency ranks in byte-aligned codes of variable length.

Ids are replaced by their rank in the corpus, so that common ids are small numbers. A
number takes one to four data bytes; its length less one is two bits of a control byte that
covers four numbers. Control bytes and data bytes are stored apart, so decoding looks up
the lengths of four numbers at a time and gathers their bytes with numpy, without a branch
per number.

A folder holds `vocabulary` (Parquet: token, n, rank), `manifest` (Parquet: one row for each
shard that was committed) and the shards. A shard is a sequence of blocks of bounded size: a header of three unsigned 32-bit
numbers (document parts, control bytes, data bytes), then for all parts their doc_ids (64 bit),
counts of numbers, counts of data bytes (32 bit each) and flag bytes, then the control bytes,
then the data bytes. A part begins at a whole control byte. All integers are little-endian.

Rows with a null text have the end id alone. Null doc_ids come first; rows that repeat a
doc_id are kept in the order in which they were read. An empty table gives a folder without shards.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postgauge.llm.tables import fresh_path, open_folder, shuffle_width, small_batches
from postgauge.llm.tokens import Encoder

BLOCK = 1 << 20  # data bytes after which a block is written
PART = 1 << 20  # ids of a document that are handled at once
KEEP = 128 << 20  # bytes of pieces that a task remembers: the fewer, the more words are encoded again
TOKENIZED = "doc_id bigint, row bigint, part int, more boolean, ids binary"
NULL_ID, CONTINUED = 1, 2  # flags of a document part
LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], "<u4")


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = np.ascontiguousarray(numbers, "<u4")
    codes = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    extra = codes[: len(numbers)]
    longer = [np.flatnonzero(numbers > top) for top in (0xFF, 0xFFFF, 0xFFFFFF)]
    for at in longer:
        extra[at] += 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    starts = np.arange(len(numbers)) + np.cumsum(extra, dtype="<i8") - extra
    digits = numbers.view(np.uint8).reshape(-1, 4)
    data = np.empty(len(numbers) + sum(map(len, longer)), np.uint8)
    data[starts] = digits[:, 0]
    for k, at in enumerate(longer, 1):
        data[starts[at] + k] = digits[at, k]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    starts = np.cumsum(lengths, dtype="<i8") - lengths
    # Any four bytes that begin at a number's place, cut to the number's own length.
    words = np.ndarray((len(data) + 1,), "<u4", data + bytes(4), strides=(1,))
    return words.take(starts) & MASKS.take(lengths)


class ShardWriter:
    """Collects the packed parts of documents and writes a block whenever enough have come."""

    def __init__(self, out):
        self.out, self.parts, self.control, self.data, self.size = out, [], [], [], 0

    def add(self, doc_id: int | None, n: int, flags: int, control: bytes, data: bytes) -> None:
        self.parts.append((doc_id or 0, n, len(data), flags | (NULL_ID if doc_id is None else 0)))
        self.control.append(control)
        self.data.append(data)
        self.size += len(data)
        if self.size >= BLOCK:
            self.flush()

    def flush(self) -> None:
        if self.parts:
            ids, counts, sizes, flags = zip(*self.parts, strict=True)
            control, data = b"".join(self.control), b"".join(self.data)
            self.out.write(struct.pack("<3I", len(ids), len(control), len(data)))
            self.out.write(np.array(ids, "<i8").tobytes() + np.array([counts, sizes], "<u4").tobytes() + bytes(flags))
            self.out.write(control + data)
        self.parts, self.control, self.data, self.size = [], [], [], 0


def read_shard(source) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """Documents of a shard in their order, each with its ranks in one or more arrays."""
    held: list[np.ndarray] = []
    while head := source.read(12):
        parts, n_control, n_data = struct.unpack("<3I", head)
        ids = np.frombuffer(source.read(8 * parts), "<i8").tolist()
        counts, sizes = np.frombuffer(source.read(8 * parts), "<u4").reshape(2, -1).tolist()
        flags, control, data = source.read(parts), source.read(n_control), source.read(n_data)
        c = d = 0
        for doc_id, n, size, flag in zip(ids, counts, sizes, flags, strict=True):
            c_end = c + -(-n // 4)
            held.append(unpack(control[c:c_end], data[d : d + size], n))
            c, d = c_end, d + size
            if not flag & CONTINUED:
                yield None if flag & NULL_ID else doc_id, held
                held = []


def _rows(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = zip(schema.types, zip(*rows, strict=True), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for t, c in columns], schema=schema)


def _numbers(ids: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all rows of a binary column, one row's after the other."""
    ends = np.frombuffer(ids.buffers()[1], "<i4")[ids.offset : ids.offset + len(ids) + 1]
    return np.frombuffer(ids.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(schema))


def id_type(size: int) -> str:
    """The stored type of ids below `size`."""
    return "<u2" if size <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str, text: str, kind: str = "<u4") -> DataFrame:
    """doc_id, row (unique), part and ids (little-endian unsigned integers of type `kind`); a document's
    parts have at most `PART` ids, the last one ends with the end id."""
    arrow = _arrow(TOKENIZED)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(tokenizer, KEEP), np.array([end_id], "<u4")
        for batch in batches:
            rows, size = [], 0
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            texts = (value.as_py() for value in batch.column(2))
            for (key, row), ids in zip(keys, encoder.many(texts), strict=True):
                ids = np.concatenate([ids, end]).astype(kind)
                for part, begin in enumerate(range(0, len(ids), PART)):
                    cut = ids[begin : begin + PART]
                    rows.append((key, row, part, begin + PART < len(ids), cut.tobytes()))
                    size += len(cut)
                if size >= PART:
                    yield from _rows(rows, arrow)
                    rows, size = [], 0
            yield from _rows(rows, arrow)

    given = small_batches(docs).select(F.col(doc_id).cast("bigint"), F.monotonically_increasing_id(), text)
    return given.mapInArrow(encode, TOKENIZED)


def token_counts(stored: DataFrame, size: int, kind: str = "<u4") -> DataFrame:
    """How often each id occurs in the corpus: (token, n). Each task sends its own sums only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0), kind), minlength=size)
        tokens = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(total[tokens])], ["token", "n"])

    return stored.select("ids").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", shards: int | None = None
) -> None:
    """Write `docs` into `path`, documents in ascending order over all shards.

    Texts are encoded once and their ids stored, in two bytes where the vocabulary allows; the ids move to their place in the order, where
    the task that writes a shard ranks and packs them. A task writes its shard under
    a name of its own and reports it; only shards whose task succeeded are in the manifest,
    so a repeated task leaves at most an unused file. The rank table is as long as the
    vocabulary, whatever the corpus.
    """
    spark = docs.sparkSession
    ids = fresh_path(spark, "ids")
    size = max(Encoder(tokenizer).size, end_id + 1)
    kind = id_type(size)
    tokenized(docs, tokenizer, end_id, doc_id, text, kind).write.option("compression", "zstd").parquet(ids)
    stored = spark.read.parquet(ids)
    by_count = W.orderBy(F.desc("n"), "token")  # as many rows as the vocabulary has
    token_counts(stored, size, kind).withColumn("rank", F.row_number().over(by_count) - 1).write.parquet(f"{path}/vocabulary")
    table = spark.read.parquet(f"{path}/vocabulary").toPandas()
    ranks = np.zeros(size, "<u4")
    ranks[table["token"].to_numpy(int)] = table["rank"].to_numpy("u4")

    report = "shard bigint, file string, n_docs bigint, n_tokens bigint"
    report_arrow = _arrow(report)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, out = f"{uuid.uuid4().hex}.ids", None
        n_docs = n_tokens = 0
        for batch in batches:
            for key, more, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if out is None:
                    system, folder = open_folder(f"{path}/shards")
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}")
                    shard = ShardWriter(out)
                numbers = ranks[np.frombuffer(ids.as_buffer(), kind)]
                shard.add(key, len(numbers), CONTINUED if more else 0, *pack(numbers))
                n_docs, n_tokens = n_docs + (not more), n_tokens + len(numbers)
        if out is not None:
            shard.flush()
            out.close()
            yield from _rows([(TaskContext.get().partitionId(), name, n_docs, n_tokens)], report_arrow)

    # Rows that share a doc_id spread over tasks, but the parts of a row stay together.
    # Ids are ranked and packed where they are written: the ranges are sampled from stored rows alone.
    placed = stored.repartitionByRange(shards or shuffle_width(spark), "doc_id", "row")
    ordered = placed.sortWithinPartitions("doc_id", "row", "part").select("doc_id", "more", "ids")
    ordered.mapInArrow(write, report).write.parquet(f"{path}/manifest")


Reduce = Callable[[int | None, np.ndarray], tuple]


def read_token_files(spark: SparkSession, path: str, reduce: Reduce | None = None, schema: str = "ids array<bigint>") -> DataFrame:
    """Documents of a folder: doc_id, start (ids before it), n_tokens, and what `reduce` makes
    of the ids (an unsigned 32-bit array); by default the ids themselves."""
    reduce = reduce or (lambda ids: (ids.astype(np.int64),))
    table = spark.read.parquet(f"{path}/vocabulary").select("token", "rank").toPandas()
    tokens = np.zeros(len(table), "<u4")
    tokens[table["rank"].to_numpy(int)] = table["token"].to_numpy("u4")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row for each shard
    manifest = spark.read.parquet(f"{path}/manifest")
    shards = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    full = f"doc_id bigint, start bigint, n_tokens bigint, {schema}"
    arrow = _arrow(full)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, folder = open_folder(f"{path}/shards")
                at, rows = row["start"], []
                with system.open_input_stream(f"{folder}/{row['file']}") as source:
                    for key, parts in read_shard(source):
                        ids = tokens.take(parts[0] if len(parts) == 1 else np.concatenate(parts))
                        rows.append((key, at, len(ids), *reduce(ids)))
                        at += len(ids)
                        if len(rows) == 1000:
                            yield from _rows(rows, arrow)
                            rows = []
                yield from _rows(rows, arrow)

    return shards.repartition(shuffle_width(spark)).mapInArrow(decode, full)


def crc32(ids: np.ndarray) -> int:
    """Checksum of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
