"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document is cut only if it is longer than a sequence; its pieces of full length are a sequence
by themselves. The other pieces are dealt at random into blocks of bounded size. A block is
a packing problem for several islands, each a row of a distributed table with a population of
its own. On an island a solution is a list of bins (sequences). Crossover injects whole
well-filled bins of one parent into the other, drops the bins that now hold a piece twice, and
best-fits the displaced pieces into what is left, the largest first. Between epochs the elite
solution of each island migrates to the next island of its block. After the last epoch the
best solution of a block stands; pieces in its poorly filled bins are dealt into new blocks
together with those of other blocks, level after level, until all are in one block or a level places
hardly any more. So the last open bin of a block is not lost.
"""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.llm.tables import materialise, small_batches
from postgauge.llm.tokens import Encoder


@dataclass(frozen=True)
class Search:
    """Settings of the search; `block` bounds the pieces that one task handles together."""

    block: int = 1024
    islands: int = 2
    epochs: int = 2
    population: int = 4
    generations: int = 4
    good_fill: float = 0.995  # bins at least so full stand after a level
    least_gain: float = 0.1  # share of its open pieces that a level must place for another one to follow
    seed: int = 11


class Bins:
    """Open bins by free space, for best fit: the bin with the least space that is enough."""

    def __init__(self, capacity: int):
        self.capacity, self.mask, self.at = capacity, 0, [[] for _ in range(capacity + 1)]

    def add(self, free: int, bin_: list[int]) -> None:
        if free:
            self.at[free].append(bin_)
            self.mask |= 1 << free

    def take(self, size: int) -> tuple[int, list[int]] | None:
        fitting = self.mask >> size
        if not fitting:
            return None
        free = size + (fitting & -fitting).bit_length() - 1
        found = self.at[free].pop()
        if not self.at[free]:
            self.mask ^= 1 << free
        return free, found


def best_fit(bins: list[list[int]], pieces: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """Put `pieces` into `bins`, which are changed, in the order given."""
    opened = Bins(capacity)
    for held in bins:
        opened.add(capacity - sum(map(sizes.__getitem__, held)), held)
    bins = list(bins)
    for piece in pieces:
        size = sizes[piece]
        found = opened.take(size)
        if found is None:
            found = (capacity, [])
            bins.append(found[1])
        found[1].append(piece)
        opened.add(found[0] - size, found[1])
    return bins


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Smaller is better: the number of bins, then how evenly they are filled."""
    return len(bins), -sum((sum(map(sizes.__getitem__, b)) / capacity) ** 2 for b in bins)


def crossover(one: list, other: list, sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Inject well-filled bins of `one` into `other`."""
    fills = sorted(((sum(map(sizes.__getitem__, b)), rng.random(), k) for k, b in enumerate(one)), reverse=True)
    good = fills[: max(1, len(fills) // 2)]
    injected = [list(one[k]) for _, _, k in rng.sample(good, max(1, len(good) // 2))]
    inside = {piece for b in injected for piece in b}
    kept, displaced = injected, []
    worst = min(sum(map(sizes.__getitem__, b)) for b in other) if other else 0
    for b in other:
        if not inside.isdisjoint(b):
            displaced += [p for p in b if p not in inside]
        elif sum(map(sizes.__getitem__, b)) == worst:  # the emptiest bin is always dissolved
            displaced += b
        else:
            kept.append(list(b))
    displaced.sort(key=lambda p: -sizes[p])
    return best_fit(kept, displaced, sizes, capacity)


def evolve(sizes: list[int], capacity: int, given: list[list[list[int]]], search: Search, seed: int) -> list[list[int]]:
    """The elite of one island after `generations`, starting from the solutions given."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    falling = sorted(range(len(sizes)), key=lambda p: -sizes[p])
    population = list(given)
    while len(population) < search.population:
        order = falling
        if population:  # all but the first start from an order shaken a little
            order = sorted(falling, key=lambda p: -sizes[p] * rng.uniform(0.9, 1.1))
        population.append(best_fit([], order, sizes, capacity))
        if len(population[-1]) == least:
            return population[-1]
    ranked = sorted(((fitness(b, sizes, capacity), k, b) for k, b in enumerate(population)))[: search.population]
    made = len(population)
    for _ in range(search.generations):
        for _ in range(search.population):
            (_, _, a), (_, _, b) = rng.sample(ranked, 2) if len(ranked) > 1 else (ranked[0], ranked[0])
            child = crossover(a, b, sizes, capacity, rng)
            made += 1
            ranked.append((fitness(child, sizes, capacity), made, child))
            if len(child) == least:
                return child
        ranked = sorted(ranked)[: search.population]
    return ranked[0][2]


def pieces(docs: DataFrame, capacity: int, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents cut to at most `capacity` ids: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(tokenizer), np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            texts = (value.as_py() for value in batch.column(1))
            for key, ids in zip(batch.column(0).to_pylist(), encoder.many(texts), strict=True):
                ids = np.concatenate([ids, end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((key, piece, start, len(part), zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            types = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return small_batches(docs).select(F.col(doc_id).cast("bigint"), text).mapInArrow(cut, schema)


def solve_blocks(problems: DataFrame, capacity: int, search: Search) -> DataFrame:
    """Best solution per block of (block, uids, sizes): block, uids, sizes, bins.

    An epoch is one pass over a stored table with a row for each block and island; a solution
    travels as one array with the bin number of every piece.
    """

    def epoch(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in batches:
                out = []
                for row in frame.itertuples(index=False):
                    sizes = [int(s) for s in row.sizes]
                    given = [_bins(list(s)) for s in (row.own, row.migrant) if s is not None]
                    least = -(-sum(sizes) // capacity)
                    done = next((g for g in given if len(g) == least), None)
                    seed = hash((search.seed, number, int(row.block), int(row.island)))
                    out.append(_places(done or evolve(sizes, capacity, given, search, seed), len(sizes)))
                yield frame[["block", "island", "uids", "sizes"]].assign(own=out)

        return run

    schema = "block bigint, island int, uids array<bigint>, sizes array<bigint>, own array<bigint>"
    islands = F.explode(F.sequence(F.lit(0), F.lit(search.islands - 1))).alias("island")
    state = problems.select("block", islands, "uids", "sizes", F.lit(None).cast("array<bigint>").alias("own"))
    ring = W.partitionBy("block").orderBy("island")  # as many rows as islands
    last = F.last("own").over(ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    for number in range(search.epochs):
        state = state.withColumn("migrant", F.coalesce(F.lag("own").over(ring), last))
        state = materialise(state.mapInPandas(epoch(number), schema))
    best = F.row_number().over(W.partitionBy("block").orderBy(F.array_max("own"), "island"))
    return state.withColumn("rank", best).where("rank = 1").select("block", "uids", "sizes", F.col("own").alias("bins"))


def _bins(places: list[int]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(max(places) + 1)]
    for piece, place in enumerate(places):
        out[int(place)].append(piece)
    return out


def _places(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, held in enumerate(bins):
        for piece in held:
            out[piece] = k
    return out


def pack(table: DataFrame, capacity: int, search: Search = Search()) -> DataFrame:
    """Sequences for pieces: the columns of `table` with sequence_id and offset.

    `table` has a column `length` of 1 to `capacity`; all of its rows are placed, also those
    that repeat. Sequence ids are unique, not consecutive. An empty table gives an empty result.
    """
    stored = materialise(table.withColumn("uid", F.monotonically_increasing_id()))
    whole = F.col("length") == capacity
    open_ = stored.where(~whole).select("uid", F.col("length").alias("size"))
    placed = stored.where(whole).select("uid", F.col("uid").alias("first"), F.lit(0).cast("bigint").alias("offset"))
    level, n = 0, open_.count()
    while n:
        blocks = math.ceil(n / search.block)
        block: Column = F.pmod(F.xxhash64("uid", F.lit(search.seed + level)), F.lit(blocks))
        dealt = open_.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("uid", "size"))).alias("p"))
        problems = dealt.select("block", F.col("p.uid").alias("uids"), F.col("p.size").alias("sizes"))
        solved = solve_blocks(problems, capacity, search)
        piece = F.explode(F.arrays_zip("uids", "sizes", "bins")).alias("p")
        rows = solved.select("block", piece).select("block", F.col("p.uids").alias("uid"), F.col("p.sizes").alias("size"), F.col("p.bins").alias("bin"))
        bin_ = W.partitionBy("block", "bin")
        rows = (
            rows.withColumn("first", F.min("uid").over(bin_))
            .withColumn("fill", F.sum("size").over(bin_))
            .withColumn("offset", F.sum("size").over(bin_.orderBy("uid")) - F.col("size"))
        )
        rows = materialise(rows.withColumn("stands", F.lit(blocks == 1) | (F.col("fill") >= search.good_fill * capacity)))
        open_ = rows.where(~F.col("stands")).select("uid", "size")
        left = open_.count()
        final = left > (1 - search.least_gain) * n
        placed = placed.unionByName(rows.where(F.col("stands") | F.lit(final)).select("uid", "first", "offset"))
        level, n = level + 1, 0 if final else left
    return stored.join(placed.withColumnRenamed("first", "sequence_id"), "uid").drop("uid")


def pack_documents(
    docs: DataFrame, capacity: int, tokenizer: str, end_id: int, search: Search = Search(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone. Rows that repeat a doc_id, and rows whose doc_id
    is null, are documents of their own.
    """
    return pack(pieces(docs, capacity, tokenizer, end_id, doc_id, text), capacity, search)
