"""How far a source's words are from those of the other sources of its language, and which words make it so.

Words are found by sorting pointers. A shard of texts is one byte buffer, as Arrow holds it; bytes
that no word has become zero, letters A to Z lower case. Every place where a word starts is a pointer, and
the pointers are put in order of the words they point at by multikey quicksort, eight bytes at a
time: a slice is split around a pivot into less, equal and more, and only the equal part goes
on to the next eight bytes. Pointers to the same word then lie in one run, in the order of their
texts, so a run yields how often each source has the word and in how many documents.

Frequencies are smoothed and scaled to whole numbers, so all sums are exact. The divergence of two
sources is the sum of (p - q)^2 / (p + q), floored per word, over all words kept in their language. A
task compares a block of sources with another on a share of the words; words that neither block
has need no row: each adds the same amount, which is multiplied in at the end. The result has a row
for every ordered pair of sources of a language, so work and rows grow with the square of the sources.

Null text, language or source count as the empty string, itself a language or source. Documents
aren't told apart by id, so repeated rows and null ids count as documents of their own. A group whose
texts hold no kept word keeps its rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.llm.tables import materialise, small_batches

SHARD_BYTES = 8 << 20  # of texts whose pointers are sorted together
SLICE = 1 << 14  # pointers of a slice that is no longer split but sorted by its next bytes
FEW = 12  # pointers of a slice that are compared as whole words
SCALE = 1_000_000_000

# The byte a word has for each byte of a text: 0 where no word goes on.
FOLDED = np.zeros(256, np.uint8)
FOLDED[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLDED[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLDED[0x80:] = np.arange(0x80, 0x100)
# Which of the next eight bytes belong to a word that goes on for 0 to 8 of them.
BELONG = np.array([(1 << 64) - (1 << 64 - 8 * k) for k in range(9)], np.uint64)


class Pointers:
    """The places where words start in a buffer of texts, and the document of each."""

    def __init__(self, data: np.ndarray, begins: np.ndarray):
        """`begins` holds where each text begins in `data`, and the end of the last."""
        n = len(data)
        self.bytes = np.zeros(n + 8, np.uint8)
        self.bytes[:n] = FOLDED[data]
        inside = self.bytes[: n + 1] != 0
        edge = np.zeros(n + 1, bool)  # where a word ends whatever follows: at the next text
        edge[begins] = True
        before = np.concatenate([[False], inside[:-1]])
        self.at = np.flatnonzero(inside & (~before | edge))
        ends = np.flatnonzero(before & (~inside | edge))
        self.lengths = ends - self.at
        self.docs = np.searchsorted(begins, self.at, side="right") - 1
        self.eights = np.ndarray(n + 1, ">u8", self.bytes.data, strides=(1,)) if n else np.zeros(1, ">u8")

    def keys(self, which: np.ndarray, depth: int) -> np.ndarray:
        """The next eight bytes of words, as numbers in the order of the bytes; zeros after a word's end."""
        left = np.clip(self.lengths[which] - 8 * depth, 0, 8)
        place = np.minimum(self.at[which] + 8 * depth, len(self.eights) - 1)
        return self.eights[place].astype(np.uint64) & BELONG[left]

    def word(self, which: int) -> bytes:
        at = self.at[which]
        return self.bytes[at : at + self.lengths[which]].tobytes()

    def sort(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`order`, a list of pointers, sorted by word and otherwise as given, and where runs begin."""
        order, new = order.copy(), np.zeros(len(order), bool)
        keys = self.keys(order, 0)
        slices = [(0, len(order), 0, False)]
        while slices:
            low, high, depth, fresh = slices.pop()
            if low == high:
                continue
            new[low] = True
            part = order[low:high]
            if high - low <= FEW:
                words = list(map(self.word, part.tolist()))
                by_word = sorted(range(high - low), key=words.__getitem__)
                order[low:high] = part[by_word]
                for k in range(1, high - low):
                    new[low + k] = words[by_word[k]] != words[by_word[k - 1]]
                continue
            here = self.keys(part, depth) if fresh else keys[low:high]
            if high - low > SLICE:
                pivot = np.sort(here[:: (high - low) // 9])[4]
                less, more = here < pivot, here > pivot
                same = ~(less | more)
                order[low:high] = np.concatenate([part[less], part[same], part[more]])
                keys[low:high] = np.concatenate([here[less], here[same], here[more]])
                one = low + int(np.count_nonzero(less))
                two = one + int(np.count_nonzero(same))
                slices += [(low, one, depth, False), (two, high, depth, False)]
                if pivot & 0xFF:  # eight bytes, so the words may go on
                    slices.append((one, two, depth + 1, True))
                else:
                    new[one] = True
                continue
            by_key = np.argsort(here, kind="stable")
            order[low:high], here = part[by_key], here[by_key]
            starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
            new[low + starts] = True
            ends = np.concatenate([starts[1:], [high - low]])
            for k in np.flatnonzero((ends - starts > 1) & (here[starts] & np.uint64(0xFF) != 0)).tolist():
                slices.append((low + int(starts[k]), low + int(ends[k]), depth + 1, True))
        return order, np.flatnonzero(new)

    def words(self, which: np.ndarray) -> pa.Array:
        """The words of some pointers as an Arrow array."""
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        data = self.bytes[np.repeat(self.at[which] - (ends - lengths), lengths) + np.arange(total)]
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_utf8(), len(which), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.utf8())


def shard_counts(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.RecordBatch:
    """Per language, source and word of a shard: occurrences and documents."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    begins = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begins[0] : begins[-1]]
    found = Pointers(data, begins - begins[0])
    pairs = pa.table([langs, sources], ["lang", "source"])
    groups = pairs.group_by(["lang", "source"]).aggregate([])
    number = {pair: k for k, pair in enumerate(zip(*groups.to_pydict().values()))}
    of_doc = np.array([number[p] for p in zip(langs.to_pylist(), sources.to_pylist())], np.int64)
    group = of_doc[found.docs]
    order, runs = found.sort(np.argsort(group, kind="stable"))
    # Within a run pointers lie by group, then by document.
    group, docs = group[order], found.docs[order]
    begin = np.zeros(len(order), bool)
    begin[runs] = True
    begin[1:] |= group[1:] != group[:-1]
    other = begin.copy()
    other[1:] |= docs[1:] != docs[:-1]
    starts = np.flatnonzero(begin)
    counts = np.diff(np.append(starts, len(order)))
    n_docs = np.add.reduceat(other, starts, dtype=np.int64) if len(starts) else counts
    which = pa.array(group[starts])
    columns = [groups["lang"].combine_chunks().take(which), groups["source"].combine_chunks().take(which)]
    columns += [found.words(order[starts]), pa.array(counts, pa.int64()), pa.array(n_docs, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "n_docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and n_docs of `docs` (lang, source, text), none of them null.

    The words of a shard are counted where it lies; only the counts move.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(0).nbytes
            if size >= SHARD_BYTES:
                yield _shard(held)
                held, size = [], 0
        if held:
            yield _shard(held)

    def _shard(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        return shard_counts(*(table.column(k).combine_chunks() for k in range(3)))

    schema = "lang string, source string, term string, n bigint, n_docs bigint"
    found = small_batches(docs).select("text", "lang", "source").mapInArrow(run, schema)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def frequency(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a word, in billionths plus one; exact, since products are decimals."""
    wide = "decimal(38,0)"
    share = F.lit(SCALE).cast(wide) * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", share, (total + 2 * terms).cast(wide)) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def compare_blocks(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums of `distance` between the sources of two blocks over the words that either has.

    `left` holds the words (source, block, term, p), `right` all sources of the blocks (source,
    block, p of a word they lack); one row for each pair with source < item.
    """
    lang, one, two = key[:3]
    names = right["source"].to_numpy(object)
    row = {name: k for k, name in enumerate(names)}
    codes, terms = pd.factorize(left["term"])
    p = np.repeat(right["none"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    p[[row[s] for s in left["source"]], codes] = left["p"].to_numpy(np.int64)
    blocks = right["block"].to_numpy()
    out = []
    for k in np.flatnonzero(blocks == one).tolist():
        others = np.flatnonzero(blocks == two)
        others = others[others > k] if one == two else others
        gap = p[others] - p[k]
        sums = (gap * gap // (p[others] + p[k])).sum(axis=1)
        out += [(lang, names[k], names[j], int(v), len(terms)) for j, v in zip(others.tolist(), sums.tolist())]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value", "seen"])


def audit_sources(
    docs: DataFrame,
    least_docs: int = 10,
    top: int = 10,
    block: int = 64,
    share: int = 2048,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources of a language by their divergence
    (part `pair`), and the `top` words that a source uses more than its language (part `term`).

    A task compares at most about `block` sources with as many others on about `share` words.
    """
    given = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    counts = materialise(term_counts(given))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("n_docs").alias("n_docs"))
    of_lang = materialise(of_lang.where(F.col("n_docs") >= least_docs).drop("n_docs"))
    totals = of_lang.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    kept = materialise(counts.join(of_lang, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"))
    # One row for each source of a language, with the numbers that its shares need.
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = given.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(totals, "lang", "left")
    filled = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("total", "terms", "total_lang")]
    groups = materialise(groups.select("lang", "source", *filled))
    known = groups.where("terms > 0")
    p, q = frequency(F.col("n"), F.col("total"), F.col("terms")), frequency(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    shares = materialise(kept.join(known, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")))

    ahead = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = ahead.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))

    pairs = pair_distances(groups, shares, block, share).withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*names).unionByName(terms.select(*names))


def pair_distances(groups: DataFrame, shares: DataFrame, block: int, share: int) -> DataFrame:
    """lang, source, item, value for all ordered pairs of the sources of a language.

    Sources are dealt into blocks and words into shares by hashes of their names. Each task is
    sent the rows of two blocks for one share of the words; its sums are added up afterwards.
    """
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n"), F.max("terms").alias("terms"))
    plan = sizes.select(
        "lang",
        F.ceil(F.col("n") / block).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") / share)).cast("int").alias("n_shares"),
    )
    own = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    # Every unordered pair of blocks that a source's block is in.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.struct(F.least(b, F.col("block")).alias("one"), F.greatest(b, F.col("block")).alias("two")),
    )

    def sent(df: DataFrame) -> DataFrame:
        return df.withColumn("meet", F.explode(meets))

    part = F.pmod(F.xxhash64("term"), F.col("n_shares")).cast("int")
    words = sent(shares.join(plan, "lang").withColumn("block", own).withColumn("share", part)).select("lang", "meet.one", "meet.two", "share", "source", "block", "term", "p")
    none = frequency(F.lit(0), F.col("total"), F.col("terms"))
    every = groups.withColumn("none", F.when(F.col("terms") > 0, none).otherwise(0).cast("bigint")).join(plan, "lang")
    every = sent(every.withColumn("block", own)).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("n_shares") - 1)))
    every = every.select("lang", "meet.one", "meet.two", "share", "source", "block", "none")
    key = ["lang", "one", "two", "share"]
    schema = "lang string, source string, item string, value bigint, seen bigint"
    partial = words.groupBy(*key).cogroup(every.groupBy(*key)).applyInPandas(compare_blocks, schema)
    summed = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    lacks = groups.select("lang", "source", "terms", F.when(F.col("terms") > 0, none).alias("none"))
    a, b = lacks.select("lang", "source", "terms", F.col("none").alias("p")), lacks.select("lang", F.col("source").alias("item"), F.col("none").alias("q"))
    both = summed.join(a, ["lang", "source"]).join(b, ["lang", "item"])
    unseen = (F.col("terms") - F.col("seen")) * distance(F.col("p"), F.col("q"))
    value = F.col("value") + F.when(F.col("terms") > 0, unseen).otherwise(0)
    one_way = materialise(both.select("lang", "source", "item", value.cast("bigint").alias("value")))
    return one_way.unionByName(one_way.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
