"""Approximate nearest neighbours by cosine: stable projections, kd-trees, a chi-square stop.

Vectors of length one are projected to a few dimensions by a matrix of independent normal
numbers. The squared projected distance of two vectors, over their squared distance, follows a
chi-square law with that many degrees of freedom. So with the k-th best squared distance at
d2, a vector that is nearer has a projection beyond d2 times the law's quantile at `sure` with
chance 1 - sure at most: a search that takes candidates in order of projected distance
may stop there.

The order comes from kd-trees. A top tree, fitted on a bounded sample, deals all rows into cells
of about `cell_rows`; a task builds a cell's own tree down to small leaves. A query first
searches its home cell; the distance found there names the other cells whose boxes it must
visit, and in each of them the search goes leaf by leaf until the test holds.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.llm.tables import materialise

PREPARED = "vec_id bigint, embedding array<double>, place array<double>, width int"
FOUND = "query_id bigint, vec_id bigint, score double"


@dataclass(frozen=True)
class Search:
    k: int = 5
    dimensions: int = 8
    sure: float = 0.95
    cell_rows: int = 8192
    leaf_rows: int = 128
    sample_rows: int = 50_000  # on which the top tree is fitted
    queries_at_once: int = 4096  # in one task, beside a cell
    seed: int = 5


def chi_square_quantile(p: float, m: int) -> float:
    """By bisection on the regularised lower incomplete gamma function."""

    def below(x: float) -> float:
        a, x = m / 2, x / 2
        term = total = 1 / a
        n = 0
        while term > 1e-16 * total:
            n += 1
            term *= x / (a + n)
            total += term
        return total * math.exp(a * math.log(x) - x - math.lgamma(a)) if x > 0 else 0.0

    low, high = 0.0, 10.0 * m + 50
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def projection(width: int, search: Search) -> np.ndarray:
    return np.random.default_rng([search.seed, width]).standard_normal((width, search.dimensions))


class Tree:
    """A kd-tree over rows of `points`, cut at medians of the widest side."""

    def __init__(self, points: np.ndarray, leaf_rows: int):
        self.points, self.leaf_rows = points, max(1, leaf_rows)
        self.nodes: list[tuple] = []  # (low, high, rows or None, left, right, axis, cut)
        self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        here = self.points[rows]
        low, high = here.min(axis=0), here.max(axis=0)
        number = len(self.nodes)
        self.nodes.append(())
        axis = int(np.argmax(high - low))
        if len(rows) <= self.leaf_rows or low[axis] == high[axis]:
            self.nodes[number] = (low, high, rows, -1, -1, 0, 0.0)
            return number
        cut = float(np.median(here[:, axis]))
        left = here[:, axis] <= cut
        if left.all():  # the median is the largest value
            left = here[:, axis] < cut
            cut = float(here[left, axis].max())
        a, b = self._build(rows[left]), self._build(rows[~left])
        self.nodes[number] = (low, high, None, a, b, axis, cut)
        return number

    def leaf_of(self, point: np.ndarray) -> int:
        at = 0
        while self.nodes[at][2] is None:
            _, _, _, left, right, axis, cut = self.nodes[at]
            at = left if point[axis] <= cut else right
        return at

    def nearest_leaves(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared distance of its box, rows) of leaves, nearest first."""
        heap = [(0.0, 0)]
        while heap:
            gap, at = heapq.heappop(heap)
            _, _, rows, left, right, _, _ = self.nodes[at]
            if rows is not None:
                yield gap, rows
                continue
            for child in (left, right):
                heapq.heappush(heap, (box_gap(point, *self.nodes[child][:2]), child))


def box_gap(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    out = np.maximum(low - point, 0) + np.maximum(point - high, 0)
    return float(out @ out)


def scaled(vectors) -> np.ndarray:
    """Vectors times powers of two, which change no cosine and round nothing, with largest components
    near 1: their squares neither overflow nor vanish."""
    vectors = np.ascontiguousarray(vectors, float)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def search_cell(cell: pd.DataFrame, queries: pd.DataFrame, search: Search) -> pd.DataFrame:
    """Best rows of a cell for each query; `bound` is a squared distance already reached."""
    if not len(cell) or not len(queries):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    vectors, ids = scaled(np.stack(cell["embedding"].to_numpy())), cell["vec_id"].to_numpy()
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    tree = Tree(np.stack(cell["place"].to_numpy()).astype(float), search.leaf_rows)
    stop = chi_square_quantile(search.sure, search.dimensions)
    out: list[tuple[int, int, float]] = []
    for query in queries.itertuples(index=False):
        vector, place = scaled(query.embedding), np.asarray(query.place, float)
        norm = np.sqrt((vector * vector).sum())
        best: list[tuple[float, int]] = []  # (-score, id), sorted, at most k
        bound = query.bound
        for gap, rows in tree.nearest_leaves(place):
            if gap > stop * bound:
                break
            # Sums row by row, so that equal vectors have equal scores wherever they lie in a leaf.
            scores = (vectors[rows] * vector).sum(axis=1) / (norms[rows] * norm)
            near = np.flatnonzero(2 - 2 * scores <= bound + 1e-12) if math.isfinite(bound) else np.arange(len(rows))
            found = zip((-scores[near]).tolist(), ids[rows[near]].tolist(), strict=True)
            best = sorted([*best, *(x for x in found if x[1] != query.vec_id)])[: search.k]
            if len(best) == search.k:
                bound = min(bound, max(0.0, 2 + 2 * best[-1][0]))
        out += [(query.vec_id, i, -s) for s, i in best]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def prepare(vectors: DataFrame, search: Search, vec_id: str, embedding: str) -> DataFrame:
    """Rows that take part, with their projections.

    Of rows with equal vectors the k + 1 smallest ids stay: no query has more of them among its
    k nearest, itself left out. The cut happens before the rows of a vector meet.
    """

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key is None or not value or None in value:
                    continue
                vector = np.array(value, float)
                if not np.isfinite(vector).all() or not vector.any():
                    continue
                vector = scaled(vector)
                norm = math.sqrt(vector @ vector)
                width = len(vector)
                if width not in matrices:
                    matrices[width] = projection(width, search)
                rows.append((key, value, (vector / norm @ matrices[width]).tolist(), width))
            if rows:
                types = pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32()
                arrays = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "embedding", "place", "width"])

    given = vectors.select(F.col(vec_id).cast("bigint"), F.col(embedding).cast("array<double>"))
    return given.mapInArrow(project, PREPARED)


def _top_trees(stored: DataFrame, search: Search) -> dict[int, Tree]:
    """A tree for each vector width, fitted on a sample drawn by a hash of the id."""
    n = stored.count()
    share = min(1.0, search.sample_rows / max(1, n))
    drawn = F.pmod(F.xxhash64("vec_id", F.lit(search.seed)), F.lit(1_000_000)) < int(share * 1_000_000)
    sample = stored.where(drawn).select("width", "place").toPandas()
    leaf = max(1, int(search.cell_rows * share))
    return {int(w): Tree(np.stack(g["place"].to_numpy()), leaf) for w, g in sample.groupby("width")}


def nearest(vectors: DataFrame, is_query, search: Search = Search(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k nearest other rows of each row for which the condition `is_query` on vec_id holds:
    query_id, rank (from 1), vec_id, score (cosine).

    Ties go to the smaller vec_id. Vectors that are null, empty, zero or hold nulls or numbers
    that are not finite take no part; only vectors of equal width are compared. A query with
    fewer than k others gets them all. Ids are taken as unique: a row is not its own
    neighbour, nor is one that repeats its id. Empty tables give no rows.
    """
    ready = materialise(prepare(vectors, search, vec_id, embedding))
    copies = W.partitionBy("embedding").orderBy("vec_id")
    kept = ready.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= search.k + 1).drop("copy")
    stored = materialise(kept)
    trees = _top_trees(stored, search)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(3).to_pylist()
            places = batch.column(2).to_pylist()
            cells = [trees[w].leaf_of(np.array(p)) if w in trees else 0 for w, p in zip(widths, places, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], [*batch.schema.names, "cell"])

    schema = PREPARED + ", cell int"
    cells = materialise(stored.mapInArrow(deal, schema))
    queries = materialise(ready.where(is_query).mapInArrow(deal, schema))

    def visit(routed: DataFrame) -> DataFrame:
        """Search of (query columns, bound) in the cells named beside them."""
        chunks = F.ceil(F.count(F.lit(1)) / search.queries_at_once).cast("int").alias("chunks")
        counts = materialise(routed.groupBy("width", "cell").agg(chunks))
        chunk = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
        asked = routed.join(counts, ["width", "cell"]).withColumn("chunk", chunk)
        held = cells.join(counts, ["width", "cell"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        keys = ["width", "cell", "chunk"]
        pairs = asked.select(*keys, "vec_id", "embedding", "place", "bound").groupBy(*keys)
        rows = held.select(*keys, "vec_id", "embedding", "place").groupBy(*keys)
        return pairs.cogroup(rows).applyInPandas(lambda q, c: search_cell(c, q, search), FOUND)

    home = materialise(visit(queries.withColumn("bound", F.lit(math.inf))))
    worst = home.groupBy("query_id").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("c"))
    bound = F.when(F.col("c") >= search.k, F.greatest(2 - 2 * F.col("s"), F.lit(0.0))).otherwise(math.inf)
    sides = [f(F.get("place", k)).alias(f"{name}{k}") for k in range(search.dimensions) for f, name in ((F.min, "l"), (F.max, "h"))]
    boxes: dict[int, list] = {}
    for r in cells.groupBy("width", "cell").agg(*sides).collect():  # one row for each cell
        low, high = (np.array([r[f"{name}{k}"] for k in range(search.dimensions)]) for name in "lh")
        boxes.setdefault(r["width"], []).append((r["cell"], low, high))
    stop = chi_square_quantile(search.sure, search.dimensions)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch["place"].to_pylist(), batch["width"].to_pylist(), batch["cell"].to_pylist(), batch["bound"].to_pylist())
            others = [
                [c for c, low, high in boxes.get(w, []) if c != own and box_gap(np.array(p), low, high) <= stop * b]
                for p, w, own, b in rows
            ]
            arrays = [*batch.columns, pa.array(others, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "others"])

    reached = queries.join(worst.select(F.col("query_id").alias("vec_id"), bound.alias("bound")), "vec_id", "left")
    reached = reached.select("vec_id", "embedding", "place", "width", "cell", F.coalesce("bound", F.lit(math.inf)).alias("bound"))
    routed = reached.mapInArrow(route, schema + ", bound double, others array<int>").drop("cell")
    routed = materialise(routed.withColumn("cell", F.explode("others")).drop("others"))
    found = home.unionByName(visit(routed)).distinct()
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= search.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
