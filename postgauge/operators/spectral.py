"""A layout from a neighbour graph: eigenvectors of its normalised adjacency.

Rows that are neighbours either way share an edge of weight 1. With A = D^-1/2 W D^-1/2 the largest
eigenvalue is 1, its vector known from the degrees; the next ones, divided by the roots of the
degrees, give coordinates that keep neighbours together. They are found by a block method:
a round applies the Chebyshev polynomials of A to a few vectors and takes the best vectors of the space
they span (Rayleigh and Ritz), the known one deflated. Rounds go on until what A does to the
vectors is the same as a multiple of them, up to `tolerance`.

The product with A is a join of edges with the vectors of their beginnings and a sum by their ends. A
row sends itself its earlier vectors along an edge to itself, so a round reads its state
once and one sort of the edges serves all of its products. Only matrices as wide as
the space (some tens) reach the driver; the vectors stay in the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.session import materialise

GUARDS = 4  # vectors beside those asked for, which make them settle faster
DEGREE = 6  # products with A in a round
ROUNDS = 40
TOLERANCE = 0.01
SEED = 42


@dataclass
class Layout:
    """`points`: the row id, `degree` and `coordinates`; per axis its eigenvalue and residual."""

    points: DataFrame
    values: list[float]
    residuals: list[float]
    rounds: int


def undirected(graph: DataFrame, row_id: str, neighbor: str) -> DataFrame:
    """Every edge of a neighbour graph once in either direction: src, dst."""
    ends = graph.select(F.col(row_id).alias("a"), F.col(neighbor).alias("b")).where("a <> b")
    both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()


def _weighted(edges: DataFrame, degrees: DataFrame) -> DataFrame:
    """Edges with the entries of A, and one edge of weight null from every row to itself."""
    of = degrees.select("id", F.sqrt("degree").alias("root"))
    begin, end = of.select(F.col("id").alias("src"), F.col("root").alias("r")), of.select(F.col("id").alias("dst"), F.col("root").alias("s"))
    entries = edges.join(begin, "src").join(end, "dst").select("src", "dst", (1 / (F.col("r") * F.col("s"))).alias("w"))
    return entries.unionByName(degrees.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(None).cast("double").alias("w")))


def _product(state: DataFrame, edges: DataFrame, width: int, first: bool) -> DataFrame:
    """The next Chebyshev block behind `history`: A times the last one, or twice that less the one before."""
    n = F.size("history")
    met = edges.join(state, F.col("src") == F.col("id"))
    factor = F.col("w") if first else 2 * F.col("w")

    def part(c: int) -> Column:
        last = F.get("history", n - width + c)
        before = F.lit(0.0) if first else F.get("history", n - 2 * width + c)
        return F.when(F.col("w").isNull(), -before).otherwise(factor * last).alias(f"c{c}")

    own = F.when(F.col("w").isNull(), F.struct("known", "history")).alias("own")
    sent = met.select("dst", own, *[part(c) for c in range(width)])
    got = sent.groupBy(F.col("dst").alias("id")).agg(F.first("own", ignorenulls=True).alias("own"), *[F.sum(f"c{c}").alias(f"c{c}") for c in range(width)])
    block = F.array(*[F.col(f"c{c}") for c in range(width)])
    return got.select("id", "own.known", F.concat("own.history", block).alias("history"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _gram(state: DataFrame, size: int) -> np.ndarray:
    """Inner products of all columns of the table, the known vector first; a task sends its sums only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                columns = np.column_stack([batch.column(0).to_numpy(), _matrix(batch.column(1), batch.num_rows)])
                total += columns.T @ columns
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    sums = state.select("known", "history").mapInArrow(run, "sums array<double>")
    cells = sums.select(F.posexplode("sums").alias("cell", "v")).groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size * size)
    for cell, v in cells:
        out[cell] = v
    return out.reshape(size, size)


def _ritz(gram: np.ndarray, width: int, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, residuals and, as combinations of all columns, the vectors that come closest.

    The blocks are T_0 to T_n of A times the first, so A times a block is the next one, or
    the mean of its neighbours; all inner products with A times a vector are in the table already.
    """
    known, rest = gram[0, 1:], gram[1:, 1:]
    rest = rest - np.outer(known, known)  # what is left without the known vector
    size = len(rest)
    space = size - width
    here = np.eye(size, space)
    there = np.zeros((size, space))
    there[width : 2 * width, :width] = np.eye(width)
    for at in range(width, space):
        there[at + width, at] = there[at - width, at] = 0.5
    lengths, turns = np.linalg.eigh(here.T @ rest @ here)
    good = lengths > 1e-10 * max(lengths.max(), np.finfo(float).tiny)
    basis = turns[:, good] / np.sqrt(lengths[good])
    seen = basis.T @ (here.T @ rest @ there) @ basis
    values, best = np.linalg.eigh((seen + seen.T) / 2)
    best = basis @ best[:, ::-1][:, :wanted]
    values = values[::-1][:wanted]
    pushed = (there @ best).T @ rest @ (there @ best)
    residuals = np.sqrt(np.maximum(np.diag(pushed) - values**2, 0.0))
    vectors = here @ best
    return values, residuals, np.vstack([-known @ vectors, vectors])


def _combine(state: DataFrame, vectors: np.ndarray) -> DataFrame:
    """The rows' new vectors as their `history`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = np.column_stack([batch.column(1).to_numpy(), _matrix(batch.column(2), batch.num_rows)])
                made = pa.array(list(columns @ vectors), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], ["id", "known", "history"])

    return state.select("id", "known", "history").mapInArrow(run, state.schema)


def spectral_layout(
    graph: DataFrame, row_id: str, neighbor: str = "neighbor", n_components: int = 2, tolerance: float = TOLERANCE, seed: int = SEED
) -> Layout:
    """Coordinates of all rows that have a neighbour, any number of them a row.

    Weighted by the degrees, every axis has mean 0 and mean square 1, and two axes are orthogonal. The
    residual of an axis is the length of A v - value * v for its vector v of length 1; a graph
    that does not get below `tolerance` in `ROUNDS` rounds is refused. Axes that a graph
    has no room for (it has fewer rows than axes) are 0. Eigenvalues of 1 belong to parts of the
    graph without an edge between them.
    """
    edges = materialise(undirected(graph, row_id, neighbor))
    degrees = materialise(edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree")))
    entries = materialise(_weighted(edges, degrees))
    total, rows = degrees.agg(F.sum("degree"), F.count(F.lit(1))).first()
    width = n_components + GUARDS

    def draw(c: int) -> Column:
        return F.xxhash64("id", F.lit(seed), F.lit(c)) / float(1 << 63)

    known = F.sqrt(F.col("degree") / F.lit(total or 1)).alias("known")
    start = degrees.select("id", known, F.array(*[draw(c) for c in range(width)]).alias("history"))
    values, residuals, rounds = np.zeros(0), np.zeros(0), 0
    while rows:
        state = start
        for k in range(DEGREE):
            state = _product(state, entries, width, k == 0)
        state = materialise(state)
        values, residuals, vectors = _ritz(_gram(state, 1 + width * (DEGREE + 1)), width, width)
        start = _combine(state, np.pad(vectors, ((0, 0), (0, width - vectors.shape[1]))))
        rounds += 1
        if (residuals[:n_components] <= tolerance).all():
            break
        if rounds == ROUNDS:
            raise RuntimeError(f"residuals {residuals[:n_components].tolist()} after {rounds} rounds")
    found = min(n_components, len(values))
    scaled = [F.get("history", F.lit(c)) / F.col("known") for c in range(n_components)]
    points = materialise(start.join(degrees, "id").select("id", "degree", *[x.alias(f"x{c}") for c, x in enumerate(scaled)]))
    # A vector's sign is free; the largest entry of each is made positive.
    tops = points.agg(*[F.max_by(f"x{c}", F.abs(f"x{c}")).alias(f"x{c}") for c in range(n_components)]).first()
    signed = [F.col(f"x{c}") * (-1.0 if (tops[c] or 0) < 0 else 1.0) for c in range(n_components)]
    points = points.select(F.col("id").alias(row_id), "degree", F.array(*signed).alias("coordinates"))
    return Layout(points, values[:found].tolist(), residuals[:found].tolist(), rounds)
