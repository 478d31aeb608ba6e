"""Benchmark passages in documents, found by Wu-Manber search over words.

A benchmark item is cut into windows of `width` consecutive words; a shorter item is one
window. All windows of one length form a pattern group. The search looks at the last two words
of the current position (a block): a shift table says how far the position can move because no
window holds that block nearer to its end. Only where the shift is zero, the bucket of windows
that end in this block is compared word by word. With rare blocks the search moves by almost a
whole window at a time.
"""

from __future__ import annotations

import pickle
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.llm.tables import fresh_path, map_beside, open_folder

# Letters A-Z become lower case; ASCII that is neither letter nor digit parts words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of any other characters, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class PatternGroup:
    """Windows of one length with their shift table and suffix buckets."""

    def __init__(self, length: int, windows: dict[tuple, list[str]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for window, items in windows.items():
            for j in range(self.block, length + 1):
                block = window[j - 2 : j] if self.block == 2 else window[0]
                self.shift[block] = min(self.shift.get(block, self.far), length - j)
            self.buckets[block].append((window, items))

    def find(self, doc: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(begin, items) of every window that occurs."""
        length, shift, far, at, end = self.length, self.shift.get, self.far, self.length - 1, len(doc)
        if self.block == 2:
            while at < end:
                block = (doc[at - 1], doc[at])
                move = shift(block, far)
                if move:
                    at += move
                    continue
                begin = at - length + 1
                here = tuple(doc[begin : at + 1])
                yield from ((begin, items) for window, items in self.buckets[block] if window == here)
                at += 1
        else:
            for at, word in enumerate(doc):
                if word in self.buckets:
                    yield at, self.buckets[word][0][1]


def pattern_groups(items: Iterable[tuple[str, list[bytes]]], width: int) -> list[PatternGroup]:
    by_length: dict[int, dict[tuple, list[str]]] = defaultdict(lambda: defaultdict(list))
    for item, found in items:
        length = min(width, len(found))
        for begin in range(len(found) - length + 1 if length else 0):
            held = by_length[length][tuple(found[begin : begin + length])]
            if item not in held:
                held.append(item)
    return [PatternGroup(length, windows) for length, windows in sorted(by_length.items())]


def covered(spans: list[tuple[int, int]]) -> int:
    """Words inside any of the spans (begin, end)."""
    total = last = 0
    for begin, end in sorted(spans):
        if end > last:
            total += end - max(begin, last)
            last = end
    return total


def store_patterns(benchmark: DataFrame, width: int, rows_per_file: int, item_id: str, text: str) -> tuple[str, DataFrame]:
    """Pattern tables in files of at most `rows_per_file` items, and a table that names them.

    The folder grows with the benchmark, a file does not: tasks hold one file at a time.
    """
    spark = benchmark.sparkSession
    folder = fresh_path(spark, "patterns")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, list[bytes]]] = []

        def flush():
            system, path = open_folder(folder)
            system.create_dir(path, recursive=True)
            name = f"{uuid.uuid4().hex}.patterns"
            with system.open_output_stream(f"{path}/{name}") as out:
                out.write(pickle.dumps(held))
            held.clear()
            return pa.RecordBatch.from_pydict({"file": [name]})

        for batch in batches:
            for item, value in zip(batch.column(0), batch.column(1), strict=True):
                held.append((item.as_py(), words(value.as_py())))
                if len(held) >= rows_per_file:
                    yield flush()
        if held:
            yield flush()

    items = benchmark.select(F.col(item_id).cast("string"), text).where(F.col(item_id).isNotNull() & F.col(text).isNotNull())
    items.mapInArrow(build, "file string").write.parquet(f"{folder}/manifest")
    return folder, spark.read.parquet(f"{folder}/manifest")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    carry: Sequence[str] | None = None,
    rows_per_file: int = 20_000,
) -> DataFrame:
    """Per document: `row` (its columns, or those in `carry`), n_words, n_hit (words inside any
    window that occurs) and `items`, the sorted ids of the items that have such a window.

    Documents are read once and never shuffled. A null text has no words; null items and items
    without words match nothing; items with equal windows are all named; rows that repeat are
    judged each by itself. An empty benchmark leaves every document clean, an empty table of
    documents gives an empty result.
    """
    folder, manifest = store_patterns(benchmark, width, rows_per_file, item_id, item_text)
    files = sorted(r["file"] for r in manifest.collect())  # one name for each `rows_per_file` items

    def start():
        system, path = open_folder(folder)

        def load(name: str) -> list[PatternGroup]:
            with system.open_input_stream(f"{path}/{name}") as source:
                return pattern_groups(pickle.loads(source.read()), width)

        only = load(files[0]) if len(files) == 1 else None

        def search(columns: list[pa.Array]) -> list[pa.Array]:
            read = [words(x.as_py()) for x in columns[0]]
            spans: list[list] = [[] for _ in read]
            items: list[set] = [set() for _ in read]
            for name in files:
                groups = only if only is not None else load(name)
                for k, doc in enumerate(read):
                    for group in groups:
                        for begin, found in group.find(doc):
                            spans[k].append((begin, begin + group.length))
                            items[k].update(found)
            counts = pa.array(map(len, read), pa.int64()), pa.array(map(covered, spans), pa.int64())
            return [*counts, pa.array([sorted(x) for x in items], pa.list_(pa.string()))]

        return search

    return map_beside(docs, [F.col(text)], start, "n_words bigint, n_hit bigint, items array<string>", carry)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    return find_contamination(docs, benchmark, width).where("n_hit = 0").select("row.*")
