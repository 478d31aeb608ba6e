"""Repeated passages, found as runs of several consecutive sentences and removed.

A sentence or line of more than `LONG` words counts as several: it is cut after the word with
the smallest checksum of every `WINDOW` neighbouring words. Such cuts depend on the words around
them alone, so they fall alike wherever a passage stands, also where it begins or ends inside
other text. Of a passage of varied words that occurs twice, at most `LONG` words at either
end thus stay out of its whole sentences: those of 50 words and more hold 20 words in two
sentences or more. Stretches of one or two different words are not cut.

From every sentence on, and back from every sentence, the shortest run that has at least
`sentences` sentences and `words` words is hashed. A run that occurs twice anywhere marks its
sentences in every place but the first (the smallest document id, then the earliest place).
Since runs slide by one sentence and are anchored at both ends, a repeated passage is
covered from its first whole sentence to its last.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postgauge.llm.tables import map_beside, materialise, small_batches

#: Full stops of Latin, Chinese, Devanagari, Arabic, Urdu, Armenian and Ethiopic script, and line ends.
STOPS = r".!?\n\u2026\u3002\uff01\uff1f\uff61\uff0e\u0964\u0965\u061f\u06d4\u0589\u1362"
#: Letters of scripts without blanks between words (Thai, Lao, Burmese, Khmer, Chinese, Japanese): each is a word.
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
LONG, WINDOW = 14, 8
CHUNK = 200_000  # runs that a task compares before they are shuffled

_PIECE = re.compile(f"[^{STOPS}]*[{STOPS}]+|[^{STOPS}]+")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_WORD = re.compile(rf"[{UNSPACED}]|[^\s{UNSPACED}]+")
_STEP = re.compile(rf"\s*(?:[{UNSPACED}]|[^\s{UNSPACED}]+)(?:\s+\Z)?")  # blanks stand before, as in sentences


def words_of(piece: str) -> list[str]:
    return _WORD.findall(piece) if _UNSPACED.search(piece) else piece.split()


class Sentences:
    """Cuts a text into sentences and lines, and the long ones of those into units of words."""

    def findall(self, text: str) -> list[str]:
        pieces = _PIECE.findall(text)
        steps = {k: _STEP.findall(p) for k, p in enumerate(pieces) if len(p) > LONG and len(words_of(p)) > LONG}
        if not steps:
            return pieces
        sums = [crc32(w.strip().lower().encode("utf-8", "surrogatepass")) for words in steps.values() for w in words]
        seen = np.lib.stride_tricks.sliding_window_view(np.array(sums, np.uint32), WINDOW)
        of = np.repeat(np.arange(len(steps)), [len(words) for words in steps.values()])
        least, most = seen.min(axis=1, keepdims=True), seen.max(axis=1, keepdims=True)
        varied = ((seen != least) & (seen != most)).any(axis=1) & (of[: len(seen)] == of[WINDOW - 1 :])
        last = WINDOW - seen[:, ::-1].argmin(axis=1) + np.arange(len(seen))  # the later one of equal words
        is_cut = np.zeros(len(sums) + 1, bool)
        is_cut[last[varied]] = True
        out, before = [], 0
        for k, piece in enumerate(pieces):
            words = steps.get(k)
            if words is None:
                out.append(piece)
                continue
            cuts = [0, *(np.flatnonzero(is_cut[before + 1 : before + len(words)]) + 1).tolist(), len(words)]
            out += ["".join(words[a:b]) for a, b in zip(cuts, cuts[1:])]
            before += len(words)
        return out


SENTENCE = Sentences()


def sentences_of(text: str) -> list[str]:
    """Consecutive pieces that together are the text; ends belong to the piece before."""
    return SENTENCE.findall(text)


def runs(text: str, sentences: int, words: int) -> list[tuple[int, int, int]]:
    """(hash, begin, end) of the runs of a text, in numbers of its pieces.

    Pieces without words (blank lines, bare punctuation) belong to no run by themselves: a run
    begins and ends with words, and white space and case don't count.
    """
    split = [words_of(s.lower()) for s in sentences_of(text)]
    at = [k for k, w in enumerate(split) if any(c.isalnum() for x in w for c in x)] if split else []
    if len(at) < sentences:
        return []
    joined = [" ".join(split[k]).encode("utf-8", "surrogatepass") for k in at]
    before = np.concatenate([[0], np.cumsum([len(split[k]) for k in at])])
    n = len(at)
    k = np.arange(n)
    # Ends of the shortest runs that begin at k, and begins of the shortest runs that end at k.
    ends = np.maximum(np.searchsorted(before, before[:-1] + words), k + sentences)
    begins = np.minimum(np.searchsorted(before, before[1:] - words, side="right") - 1, k + 1 - sentences)
    forth, back = ends <= n, begins >= 0
    found = np.unique(np.concatenate([k[forth] * (n + 1) + ends[forth], begins[back] * (n + 1) + k[back] + 1]))
    whole = memoryview(b"\n".join(joined))
    starts = np.concatenate([[0], np.cumsum([len(j) + 1 for j in joined])]).tolist()
    pairs = [divmod(x, n + 1) for x in found.tolist()]
    return [(xxhash.xxh3_64_intdigest(whole[starts[a] : starts[b] - 1]), at[a], at[b - 1] + 1) for a, b in pairs]


def known_again(hashes: np.ndarray, doc_ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Which of these runs have an earlier one of their hash among these."""
    order = np.lexsort((begins, doc_ids, hashes))
    h, d, b = hashes[order], doc_ids[order], begins[order]
    opens = np.concatenate([[True], h[1:] != h[:-1]])
    first = np.flatnonzero(opens)[np.cumsum(opens) - 1]
    known = np.empty(len(order), bool)
    known[order] = (d != d[first]) | (b != b[first])
    return known


def spans(docs: DataFrame, sentences: int, words: int, doc_id: str, text: str) -> DataFrame:
    """(hash, doc_id, begin, end, known) of every run of every document.

    `known` runs have an earlier one among the `CHUNK` or so runs that a task holds at a time.
    Their hash has told all it can, and a checksum of their document takes its place; so a run that
    fills a third of all text goes to one task once for every chunk only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held += [(h - (1 << 63), key, a, b) for h, a, b in runs(value.as_py() or "", sentences, words)]
                if len(held) >= CHUNK:
                    yield marked(held)
                    held = []
        if held:
            yield marked(held)

    def marked(held: list[tuple]) -> pa.RecordBatch:
        hashes, doc_ids, begins, ends = (np.array(c, np.int64) for c in zip(*held))
        known = known_again(hashes, doc_ids, begins)
        columns = [hashes, doc_ids, begins.astype(np.int32), ends.astype(np.int32), known]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", "doc_id", "begin", "end", "known"])

    given = small_batches(docs).select(F.col(doc_id).cast("bigint"), text).where(F.col(doc_id).isNotNull())
    found = given.mapInArrow(run, "hash bigint, doc_id bigint, begin int, end int, known boolean")
    return found.withColumn("hash", F.when(F.col("known"), F.xxhash64("doc_id")).otherwise(F.col("hash")))


def repeated_spans(docs: DataFrame, sentences: int, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and `spans`, the places (begin, end) of its runs that occurred before.

    Runs are shuffled once, at any size of the table, and meet in the order of their places.
    """
    places = Window.partitionBy("hash", "known").orderBy("doc_id", "begin")
    ranked = spans(docs, sentences, words, doc_id, text).withColumn("place", F.rank().over(places))
    later = ranked.where(F.col("known") | (F.col("place") > 1))
    return later.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))


def remove_repeated(
    docs: DataFrame, sentences: int = 2, words: int = 20, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` without the sentences of repeated runs, and `n_removed`, how many those were.

    Texts without such runs are returned as they are, null and empty ones too. Rows with one
    doc_id are one document and no repetition of each other; rows without doc_id are neither
    compared nor changed. Of equal documents the one with the smallest id keeps its text.
    A column named `n_removed` is replaced; other columns may have any name. Empty tables give
    empty results.
    """
    found = materialise(repeated_spans(docs, sentences, words, doc_id, text)).select(
        F.col("doc_id").alias("key"), F.lit(0).alias("salt"), "spans"
    )
    key = F.col(doc_id).cast("bigint")
    columns = [c for c in docs.columns if c != "n_removed"]
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("given"),
        key.alias("key"),
        # Rows without an id meet nothing, but must not fill one task.
        F.when(key.isNull(), F.pmod(F.xxhash64(text), F.lit(1 << 20)).cast("int")).otherwise(F.lit(0)).alias("salt"),
    )
    # Texts move once, to their spans, which may be as many as the texts.
    marked = given.join(found, ["key", "salt"], "left")

    def start():
        def work(columns: list[pa.Array]) -> list[pa.Array]:
            texts, counts = [], []
            for value, places in zip(columns[0], columns[1], strict=True):
                places, value = places.as_py(), value.as_py()
                gone: set[int] = set()
                for p in places or ():
                    gone.update(range(p["begin"], p["end"]))
                texts.append("".join(s for k, s in enumerate(sentences_of(value)) if k not in gone) if gone else value)
                counts.append(len(gone))
            return [pa.array(texts, pa.string()), pa.array(counts, pa.int64())]

        return work

    kept = F.struct(*[F.col(f"given.`{c}`") for c in columns if c != text]).alias("kept")
    beside = marked.select(F.col(f"given.`{text}`").alias("text"), "spans", kept)
    done = map_beside(beside, [F.col("text"), F.col("spans")], start, "made string, n_removed bigint", carry=["kept"])
    out = [F.col("made").alias(c) if c == text else F.col(f"row.kept.`{c}`").alias(c) for c in columns]
    return done.select(*out, "n_removed")
