"""Importance resampling: documents drawn by how much they look like a target's texts.

Features are runs of one to `longest` consecutive words, hashed into buckets. A batch of texts is
joined into one buffer with a separator byte that no word holds; one pass of a pattern finds all
words, a binary search in the documents' offsets tells whose they are, and runs that reach over
a separator are masked before anything is counted. The checksum of a run is that of its beginning
carried on over the next word, so no run is ever built.

The log ratio of target to corpus frequency of a bucket is its gain; a document's weight is the mean
gain of its features. Seeded Gumbel noise on top makes the highest scores a draw without
replacement in proportion to the exponential weights.

Null text has no words, so no features and weight 0. A null id counts as the empty string in
the noise and comes last among ties. Rows that repeat are documents of their own, and have the same
score; rows that tie in score and id are ranked in any order. An empty target or an empty
table gives gains from the other counts alone; an empty table of documents an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.llm.tables import Work, map_beside, materialise, shuffle_width, small_batches

# Of bytes, lower case: digits, letters, and all that UTF-8 has beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"


def code_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def hashed_runs(texts: list[bytes | None], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and features per text, and the buckets of all features, text after text."""
    joined = SEPARATOR.join(text or b"" for text in texts).lower()
    begins = np.cumsum([0, *(len(text or b"") + 1 for text in texts)])[:-1]
    words, places = [], []
    for found in WORD.finditer(joined):
        words.append(found.group())
        places.append(found.start())
    n = len(words)
    owner = np.searchsorted(begins, np.array(places, np.int64), side="right") - 1
    n_words = np.bincount(owner, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    left = np.cumsum(n_words)[owner] - np.arange(n)  # words from here to the end of the text
    made = np.minimum(left, longest)  # runs that begin at a word
    first = np.cumsum(made) - made
    codes = np.empty(int(made.sum()), code_type(buckets))
    sums = list(map(crc32, words))
    spaced = [b" " + word for word in words] if longest > 1 else []
    for length in range(1, longest + 1):
        if length > 1:
            sums = list(map(crc32, spaced[length - 1 :], sums))
        inside = made[: len(sums)] >= length
        hashes = np.array(sums, np.uint32)[inside]
        codes[first[: len(sums)][inside] + length - 1] = hashes % buckets
    n_features = np.bincount(owner, made, len(texts)).astype(np.int64) if n else n_words
    return n_words, n_features, codes


def hashed(docs: DataFrame, longest: int, buckets: int, text: str, carry: list[str] | None) -> DataFrame:
    """The struct `row`, n_words, and codes: the buckets of a text's features as little-endian integers."""

    def start() -> Work:
        def work(arrays: list[pa.Array]) -> list[pa.Array]:
            n_words, n_features, codes = hashed_runs(arrays[0].cast(pa.binary()).to_pylist(), longest, buckets)
            ends = np.cumsum([0, *n_features]) * codes.itemsize
            return [pa.array(n_words, pa.int64()), _binaries(codes.tobytes(), ends)]

        return work

    return map_beside(docs, [F.col(f"`{text}`").cast("string")], start, "n_words bigint, codes binary", carry)


def _binaries(data: bytes, ends: np.ndarray) -> pa.Array:
    at = pa.array([data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())
    return at


def bucket_counts(stored: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket; each task sends at most `buckets` sums."""
    code = code_type(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for codes in batch.column(0):
                total += np.bincount(np.frombuffer(codes.as_buffer(), code), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["bucket", "n"])

    given = small_batches(stored).select("codes").mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in given.groupBy("bucket").agg(F.sum("n")).collect():  # as many rows as buckets
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log ratio of the smoothed frequencies, floored, per bucket."""
    s_all, t_all, k = float(corpus.sum()), float(target.sum()), len(corpus)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in pairs], np.int64)


def weighed(stored: DataFrame, gain: np.ndarray) -> DataFrame:
    """`row` and `n_words` with n_features and weight, the floored mean gain of the features."""
    code = code_type(len(gain))

    def start() -> Work:
        def work(arrays: list[pa.Array]) -> list[pa.Array]:
            codes = [np.frombuffer(x.as_buffer(), code) for x in arrays[0]]
            weights = [int(gain[c].sum()) // len(c) if len(c) else 0 for c in codes]
            return [pa.array(list(map(len, codes)), pa.int64()), pa.array(weights, pa.int64())]

        return work

    done = map_beside(stored, [F.col("codes")], start, "n_features bigint, weight bigint", ["row", "n_words"])
    return done.select("row.row", "row.n_words", "n_features", "weight")


def ranked(stored: DataFrame, order: list, name: str) -> DataFrame:
    """Rows numbered from 1 by `order`, without one task for all.

    Rows are dealt by sampled ranges of the order, ties apart; within a range a row's number
    is its place, and before it come the counted rows of the ranges before.
    """
    spark, tie = stored.sparkSession, F.monotonically_increasing_id()
    dealt = stored.withColumn("_tie", tie).repartitionByRange(shuffle_width(spark), *order, "_tie").sortWithinPartitions(*order, "_tie")
    placed = materialise(dealt.withColumn("_tie", F.monotonically_increasing_id()))  # the range, then 33 bits of place
    range_, place = F.shiftright("_tie", 33), F.col("_tie").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(range_.alias("_range")).agg(F.count("*").alias("_n"))  # one row for each range
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("_range", before.alias("_before")))
    joined = placed.join(starts, range_ == F.col("_range"))
    return joined.withColumn(name, F.col("_before") + place + 1).drop("_tie", "_range", "_n", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    seed: int = 7,
    least_words: int = 20,
    longest: int = 2,
    buckets: int = 10_000,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """The struct `row` (all columns of `docs`, or those in `carry`), n_features, weight, score, rank.

    `target` has the same text column. Of the documents with at least `least_words` words, `percent`
    in a hundred are drawn; the others' rank is null. Texts are read once; what is stored are two bytes a
    feature, and only rows with enough words move, for their rank: carry narrow columns
    where texts needn't come along.
    """
    noise_id = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    kept = docs.columns if carry is None else carry
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")]).alias("row"),
        F.col(f"`{doc_id}`").alias("id"),
        F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), noise_id), 256), 1, 8), 16, 10).cast("double").alias("noise"),
        F.col(f"`{text}`").alias("text"),
    )
    stored = materialise(hashed(given, longest, buckets, "text", ["row", "id", "noise"]))
    wanted = materialise(hashed(target, longest, buckets, text, []))
    gain = gains(bucket_counts(stored, buckets), bucket_counts(wanted, buckets))
    gumbel = F.floor(-1000 * F.log(-F.log((F.col("row.noise") + 0.5) / 4294967296.0))).cast("bigint")
    scores = weighed(stored, gain).select(
        F.col("row.row").alias("row"), F.col("row.id").alias("id"), "n_words", "n_features", "weight", (F.col("weight") + gumbel).alias("score")
    )
    scores = materialise(scores)
    enough = F.col("n_words") >= least_words
    n = scores.where(enough).count()
    in_order = ranked(scores.where(enough), [F.desc("score"), F.asc_nulls_last("id")], "place")
    drawn = in_order.withColumn("rank", F.when(F.col("place") <= percent * n // 100, F.col("place")))
    rest = scores.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    names = ["row", "n_features", "weight", "score", "rank"]
    return drawn.select(*names).unionByName(rest.select(*names))
