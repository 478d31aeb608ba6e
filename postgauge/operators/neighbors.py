"""Exact k nearest neighbours without comparing every pair.

Rows are assigned to the nearest of a few pivots, and cells that are still large to the
nearest of pivots of their own, and so on: a tree whose leaves keep their size as the table
grows. What is known about a cell (its radius, its rows closest to the pivot) bounds, by the
triangle inequality, how far a row's k-th neighbour can be, and a cell that cannot hold
anything nearer is never visited. Every leaf is searched for its own rows first. Then leaves that
lie together make teams of bounded size, and two teams meet in one task, once, if a row of
either may have a neighbour in the other; so where vectors have so many dimensions that nothing can
be left out, rows are sent once for each team, not once for each leaf, and no task holds more than
two teams. With `probes` a row goes down the tree level by level; below the first level a cell's
pivots meet its visitors as a table. Only the k best per row leave a task. Copies of a vector are
searched once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.operators.lookup import fits
from postgauge.session import materialise

MAX_PIVOTS = 1024  # of the first level, and of every cell below it
BLOCK_ROWS = 1024
SPLIT = 4  # blocks that a cell may hold before it is split
MAX_LEVELS = 12
ROUTED = 16 * BLOCK_ROWS  # rows of a cell that one task assigns or routes
BROADCAST_CELLS = 100_000
# Numbers one chunk of bounds may hold.
CHUNK_NUMBERS = 1 << 22
BROADCAST_COPIES = 10_000
# Numbers that the vectors of one team may hold, and teams made at least, where there are leaves enough.
TEAM_NUMBERS = 1 << 21
TEAMS = 12
SLICE_ROWS = 4096  # rows of a team that look for neighbours together
MEASURED = 1 << 16  # pairs measured at a time


def _unit(df: DataFrame) -> DataFrame:
    """Unit vectors with one more coordinate, which sets the zero vector apart from all others."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    scaled = F.transform("vector", lambda x: F.coalesce(F.try_divide(x, F.col("norm")), F.lit(0.0)))
    tail = F.when(F.col("norm") == 0, 1.0).otherwise(0.0)
    return df.withColumn("norm", norm).select("id", F.concat(scaled, F.array(tail)).alias("vector"))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances by a matrix product, measured from the middle of `b`, where they cancel least."""
    middle = b.mean(0)
    a, b = a - middle, b - middle
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _error(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the squares of a row's `_distances` may be off by: rounding grows with the norms."""
    middle = b.mean(0)
    a, b = a - middle, b - middle
    eps, width = np.finfo(float).eps, a.shape[1]
    largest = (a * a).sum(1) + (b * b).sum(1).max() + eps * width * np.abs(middle).max() ** 2
    return 8.0 * (width + 4) * eps * largest[:, None] + np.finfo(float).tiny


def _off(distance: np.ndarray, error: np.ndarray) -> np.ndarray:
    """The error of distances whose squares have `error`."""
    return error / np.maximum(distance, np.sqrt(error))


def _nearest_pivot(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _distances(vectors, pivots)
    cell = d.argmin(1)
    return cell, d[np.arange(len(d)), cell]


def _assign(pivots: np.ndarray):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                cell, distance = _nearest_pivot(np.stack(pdf["vector"].to_numpy()), pivots)
                yield pdf.assign(cell=cell.astype(str), to_pivot=distance)

    return run


def _assign_below(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """Rows of a cell moved to the nearest of its own pivots."""
    if rows.empty:
        return rows[["rep", "vector", "cell", "to_pivot"]]
    pivots = pivots.sort_values("child")
    child, distance = _nearest_pivot(np.stack(rows["vector"].to_numpy()), np.stack(pivots["pivot"].to_numpy()))
    names = (pivots["cell"].iloc[0] + "." + pivots["child"].astype(str)).to_numpy()
    return rows[["rep", "vector"]].assign(cell=names[child], to_pivot=distance)


class _Cells:
    """Sibling cells, and which of them a row has to visit.

    `reach`, the distance of the k-th neighbour at home, and the bound from the pivots
    are both upper limits; the smaller one travels on. With `probes`, of the cells that may hold
    a neighbour only so many are visited, those with the nearest pivots.
    """

    def __init__(self, pivots, radius, inner, nearest, k: int, probes: int | None):
        self.pivots, self.radius, self.inner, self.nearest, self.k, self.probes = pivots, radius, inner, nearest, k, probes
        self.between = _distances(pivots, pivots)
        np.fill_diagonal(self.between, np.inf)
        self.step = max(1, CHUNK_NUMBERS // nearest.size)

    def open(self, vectors: np.ndarray, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = _distances(vectors, self.pivots)
        closest = d.argmin(1)
        own = d[np.arange(len(d)), closest][:, None]
        error = _error(vectors, self.pivots)
        upper = self.nearest + _off(self.nearest, error.max())
        reach = ((d + _off(d, error))[:, :, None] + upper[None, :, :]).reshape(len(d), -1)
        # The row itself may be among the counted ones, hence index k, not k - 1.
        limit = np.partition(reach, self.k, axis=1)[:, self.k] if reach.shape[1] > self.k else np.full(len(d), np.inf)
        limit = np.minimum(limit, reached)
        outside = np.maximum(d - self.radius - _off(self.radius, error), self.inner - d - _off(self.inner, error)) - _off(d, error)
        floor = np.maximum(outside, (d * d - own * own - 2.0 * error) / (2.0 * self.between[closest]))
        open_cells = floor <= (limit * (1 + 1e-6))[:, None]
        if self.probes is not None and self.probes < d.shape[1]:
            open_cells &= np.argsort(np.argsort(d, axis=1), axis=1) < self.probes
        return open_cells, limit

    def visits(self, rows: pd.DataFrame, names: np.ndarray) -> pd.DataFrame:
        """Every row once for each further cell that may hold one of its k nearest.

        A row's own leaf was searched before; a cell above it is visited whatever its bounds.
        """
        parts = []
        for at in range(0, len(rows), self.step):
            part = rows.iloc[at : at + self.step]
            open_cells, limit = self.open(np.stack(part["vector"].to_numpy()), part["reach"].to_numpy())
            leaves = part["leaf"].to_numpy()
            home = names[None, :] == leaves[:, None]
            # Cells above the row's own leaf: all siblings lie at the same depth.
            depth = names[0].count(".") + 1
            roots = np.array([".".join(leaf.split(".")[:depth]) for leaf in leaves], dtype=object)
            above = names[None, :] == roots[:, None]
            r, c = np.nonzero((open_cells | above) & ~home)
            parts.append(part[["rep", "vector", "leaf"]].iloc[r].assign(reach=limit[r], cell=names[c]))
        return pd.concat(parts) if parts else rows[["rep", "vector", "leaf", "reach"]].assign(cell="")


VISITS = "rep bigint, vector array<double>, leaf string, reach double, cell string"


def _route(cells: _Cells, names: np.ndarray):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield cells.visits(pdf, names)[["rep", "vector", "leaf", "reach", "cell"]]

    return run


def _route_below(k: int, probes: int | None):
    def run(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return rows[["rep", "vector", "leaf", "reach", "cell"]]
        nearest = np.full((len(nodes), k + 1), np.inf)
        for i, found in enumerate(nodes["nearest"]):
            nearest[i, : len(found)] = found
        pivots = np.stack(nodes["pivot"].to_numpy())
        cells = _Cells(pivots, nodes["hi"].to_numpy(), nodes["lo"].to_numpy(), nearest, k, probes)
        return cells.visits(rows, nodes["node"].to_numpy(object))[["rep", "vector", "leaf", "reach", "cell"]]

    return run


def _best(k: int, digits: int | None):
    """The k best members of one block, within reach, for every visiting row of one block.

    Distances from the matrix product choose who is measured again without
    cancellation: all that come within a hair of the k-th, so equal distances are all
    there to be ordered by id. `digits` rounds before that, where equal distances may
    differ in the last bit.
    """

    def measure(q: np.ndarray, m: np.ndarray, q_ids: np.ndarray, m_ids: np.ndarray, reach: np.ndarray) -> pd.DataFrame:
        d = _distances(q, m)
        d[q_ids[:, None] == m_ids[None, :]] = np.inf
        edge = np.partition(d, k - 1, axis=1)[:, k - 1 : k] if d.shape[1] > k else np.full((len(d), 1), np.inf)
        error = _error(q, m)
        widest = np.minimum(edge, reach[:, None])
        rows, cols = np.nonzero(d <= widest * (1 + 1e-6) + 2.0 * _off(widest, error))
        exact = np.sqrt(((q[rows] - m[cols]) ** 2).sum(1))
        if digits is not None:
            exact = exact.round(digits)
        out = pd.DataFrame({"rep": q_ids[rows], "other": m_ids[cols], "distance": exact})
        out = out[out["rep"] != out["other"]].sort_values(["rep", "distance", "other"])
        return out.groupby("rep").head(k)

    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or members.empty:
            return pd.DataFrame({"rep": [], "other": [], "distance": []}).astype({"rep": "int64", "other": "int64"})
        q, m = np.stack(queries["vector"].to_numpy()), np.stack(members["point"].to_numpy())
        q_ids, m_ids, reach = queries["rep"].to_numpy(), members["other"].to_numpy(), queries["reach"].to_numpy()
        step = max(1, CHUNK_NUMBERS // m.size)
        parts = [slice(i, i + step) for i in range(0, len(q), step)]
        return pd.concat([measure(q[at], m, q_ids[at], m_ids, reach[at]) for at in parts])

    return run


def _candidates(a: np.ndarray, b: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of all pairs that may be as near as the row's `limit` and among its k nearest.

    One product in single precision decides, with its error allowed for; where that leaves
    too many, one in double precision.
    """
    middle = b.mean(0)
    a, b = a - middle, b - middle
    width, double = a.shape[1], np.finfo(float).eps
    squares, halves = (a * a).sum(1), (b * b).sum(1) / 2
    largest = squares + 2 * halves.max()
    edge = (limit * (1 + 1e-6)) ** 2 - squares
    for kind in (np.float32, np.float64):
        if kind is np.float32 and not largest.max() < 1e30:
            continue
        error = 8.0 * (width + 4) * (np.finfo(kind).eps * largest + double * width * np.abs(middle).max() ** 2) + np.finfo(kind).tiny
        # |x - y|^2 <= limit^2 is x.y - |y|^2 / 2 >= (|x|^2 - limit^2) / 2.
        least = (-(edge + 2 * error) / 2).astype(kind)
        product = np.column_stack([a, np.ones(len(a))]).astype(kind) @ np.column_stack([b, -halves]).astype(kind).T
        hits = product >= least[:, None]
        if np.count_nonzero(hits) > 4 * k * len(a) and len(b) > k:
            kth = np.partition(product, len(b) - k, axis=1)[:, len(b) - k]
            hits = product >= np.maximum(least, kth - 2 * error.astype(kind))[:, None]
        if kind is np.float64 or np.count_nonzero(hits) <= 8 * k * len(a):
            break
    # One flat search for the few hits is many times faster than one in two dimensions.
    return np.divmod(np.flatnonzero(hits), len(b))


def _measure(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray, digits: int | None) -> np.ndarray:
    """Distances of single pairs, without cancellation."""
    parts = [slice(i, i + MEASURED) for i in range(0, len(rows), MEASURED)]
    exact = np.concatenate([np.zeros(0), *(np.sqrt(((a[rows[at]] - b[cols[at]]) ** 2).sum(1)) for at in parts)])
    return exact if digits is None else exact.round(digits)


class _Team:
    """The rows of a team, ordered by their leaves, without those that have no distance."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        leaf = table.column("leaf").combine_chunks().dictionary_encode()
        names, codes = leaf.dictionary.to_pylist(), leaf.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        order = order[np.isfinite(vectors[order]).all(1)]
        self.vectors, self.codes, self.names = vectors[order], codes[order], names
        self.rep, self.reach = table.column("rep").to_numpy()[order], table.column("reach").to_numpy()[order]

    def leaves(self) -> list[tuple[str, slice]]:
        starts = np.flatnonzero(np.diff(self.codes, prepend=-1))
        return [(self.names[self.codes[s]], slice(s, e)) for s, e in zip(starts, [*starts[1:], len(self.codes)])]


def _nearest_of(queries: _Team, members: _Team, k: int, digits: int | None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """`rep, other, distance`: for each row the k nearest of the members in other leaves, within its reach."""
    leaves, out = members.leaves(), []
    if not leaves or not len(queries.rep):
        return out
    centres = np.stack([members.vectors[at].mean(0) for _, at in leaves])
    radius = np.array([np.sqrt(((members.vectors[at] - c) ** 2).sum(1)).max() for (_, at), c in zip(leaves, centres)])
    codes = {name: code for code, name in enumerate(queries.names)}
    for begin in range(0, len(queries.rep), SLICE_ROWS):
        part = slice(begin, begin + SLICE_ROWS)
        vectors, limit, own = queries.vectors[part], queries.reach[part].copy(), queries.codes[part]
        d = _distances(vectors, centres)
        floor = d - radius - _off(radius, _error(vectors, centres)) - _off(d, _error(vectors, centres))
        best, waiting, count = (np.zeros(0, int), np.zeros(0, int), np.zeros(0)), [], 0

        def settle() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows, others, distances = (np.concatenate(c) for c in zip(best, *waiting))
            order = np.lexsort((others, distances, rows))
            rows, others, distances = rows[order], others[order], distances[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            last = place == k - 1
            limit[rows[last]] = np.minimum(limit[rows[last]], distances[last])
            kept = (place < k) & (distances <= limit[rows])
            return rows[kept], others[kept], distances[kept]

        for leaf in d.mean(0).argsort():
            name, at = leaves[leaf]
            near = np.flatnonzero((floor[:, leaf] <= limit * (1 + 1e-6)) & (own != codes.get(name, -1)))
            step = max(1, CHUNK_NUMBERS // max(1, len(near)))
            for first in range(at.start, at.stop if len(near) else at.start, step):
                chunk = slice(first, min(first + step, at.stop))
                rows, cols = _candidates(vectors[near], members.vectors[chunk], limit[near], k)
                rows, distances = near[rows], _measure(vectors, members.vectors[chunk], near[rows], cols, digits)
                found = distances <= limit[rows]
                waiting.append((rows[found], members.rep[chunk][cols[found]], distances[found]))
                count += len(waiting[-1][0])
                if count > 2 * k * len(vectors):
                    best, waiting, count = settle(), [], 0
        rows, others, distances = settle()
        out.append((queries.rep[part][rows], others, distances))
    return out


def _between(k: int, digits: int | None):
    """Two teams, either the other's members; a team paired with itself is searched once."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = _Team(left), _Team(right)
        found = _nearest_of(a, b, k, digits) + ([] if key[0] == key[1] else _nearest_of(b, a, k, digits))
        empty = [(np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0))]
        columns = [pa.array(np.concatenate(c)) for c in zip(*(found or empty))]
        return pa.Table.from_arrays(columns, ["rep", "other", "distance"])

    return run


def _gathered(pivots: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """A team for each cell: cells are halved across their widest direction until they hold `most` rows."""
    teams, open_, made = np.zeros(len(pivots), int), [np.arange(len(pivots))], 0
    while open_:
        at = open_.pop()
        if len(at) > 1 and sizes[at].sum() > most:
            spread = pivots[at] - pivots[at].mean(0)
            order = at[(spread @ np.linalg.eigh(spread.T @ spread)[1][:, -1]).argsort(kind="stable")]
            total = sizes[order].cumsum()
            cut = min(max(1, int(np.searchsorted(total, total[-1] / 2))), len(at) - 1)
            open_ += [order[:cut], order[cut:]]
        else:
            teams[at], made = made, made + 1
    return teams


def _teams(leaving: DataFrame, sizes: DataFrame, pivots: np.ndarray, counts: np.ndarray, block_rows: int) -> tuple[DataFrame, np.ndarray, int]:
    """`rep, vector, leaf, reach, base, team`, the centres of the bases and the rows a team is meant to have.

    A base is first-level cells that lie together. One that is too large is cut by its leaves, and a leaf
    that is too large by its rows.
    """
    most = min(TEAM_NUMBERS // pivots.shape[1], max(block_rows, math.ceil(counts.sum() / TEAMS)))
    most = max(1, most)
    pivots = np.nan_to_num(pivots)
    bases = _gathered(pivots, counts, most)
    centres = np.stack([np.average(pivots[bases == b], axis=0, weights=np.maximum(counts[bases == b], 1)) for b in range(bases.max() + 1)])
    spark = leaving.sparkSession
    roots = spark.createDataFrame([(str(c), int(b)) for c, b in enumerate(bases)], "root string, base int")
    cut = W.partitionBy("base").orderBy("cell")  # one row for each leaf
    named = sizes.withColumn("root", F.substring_index("cell", ".", 1)).join(F.broadcast(roots), "root").select(
        F.col("cell").alias("leaf"),
        "base",
        F.floor((F.sum("n").over(cut) - F.col("n")) / most).alias("turn"),
        F.ceil(F.col("n") / most).cast("int").alias("salts"),
    )
    salt = F.pmod(F.xxhash64("rep"), F.col("salts"))
    team = F.concat_ws(".", "base", "turn", salt).alias("team")
    dealt = leaving.join(_light(materialise(named)), "leaf").select("rep", "vector", "leaf", "reach", "base", team)
    return materialise(dealt), centres, most


def _rows_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _meetings(dealt: DataFrame, centres: np.ndarray) -> DataFrame:
    """Pairs `a, b` of teams, a <= b, of which a row of one may have a neighbour in the other."""
    step = max(1, CHUNK_NUMBERS // max(len(centres), centres.shape[1]))

    def far(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                base = part.column("base").to_numpy()
                d = np.sqrt(((_rows_of(part, "vector") - centres[base]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([part.column("team"), part.column("base"), pa.array(d)], ["team", "base", "d"])

    # Rows without a distance are nobody's neighbours.
    reached = dealt.select("team", "base", "vector").mapInArrow(far, "team string, base int, d double").where("not isnan(d)")
    spans = reached.groupBy("team").agg(F.first("base").alias("base"), F.max("d").alias("radius")).collect()  # one row for each team
    names = np.array([r["team"] for r in spans], dtype=object)
    base, radius = np.array([r["base"] for r in spans], int), np.array([r["radius"] for r in spans], float)

    def meet(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, CHUNK_NUMBERS // max(len(names), centres.shape[1], 1))):
                part = batch.slice(at, max(1, CHUNK_NUMBERS // max(len(names), centres.shape[1], 1)))
                vectors, teams = _rows_of(part, "vector"), part.column("team").to_numpy(zero_copy_only=False)
                d, error = _distances(vectors, centres), _error(vectors, centres)
                floor = (d - _off(d, error))[:, base] - radius * (1 + 1e-9)
                open_ = floor <= (part.column("reach").to_numpy() * (1 + 1e-6))[:, None]
                pairs = {(a, b) if a <= b else (b, a) for a in set(teams) for b in names[open_[teams == a].any(0)]}
                columns = [pa.array([p[i] for p in pairs], pa.string()) for i in range(2)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return dealt.select("team", "vector", "reach").mapInArrow(meet, "a string, b string").distinct()


def _exchanged(dealt: DataFrame, centres: np.ndarray, k: int, digits: int | None) -> DataFrame:
    """Neighbours found in other leaves, within reach."""
    pairs = _light(materialise(_meetings(dealt, centres)))

    def side(team: str, pairs: DataFrame) -> DataFrame:
        rows = dealt.select(*[F.col(c).alias(c) for c in ("rep", "vector", "leaf", "reach")], F.col("team").alias(team))
        return rows.join(pairs, team).groupBy("a", "b")

    left, right = side("a", pairs), side("b", pairs.select(F.col("a").alias("a"), F.col("b").alias("b")))
    return left.cogroup(right).applyInArrow(_between(k, digits), "rep bigint, other bigint, distance double")


def _closest(df: DataFrame, key: str, other: str, k: int) -> DataFrame:
    order = W.partitionBy(key).orderBy("distance", other)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _nodes(placed: DataFrame, k: int) -> DataFrame:
    """Per cell what its visitors have to know: n, hi and lo, and the k + 1 smallest distances to its pivot."""
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("to_pivot").alias("hi"), F.min("to_pivot").alias("lo"))
    first = W.partitionBy("cell").orderBy("to_pivot")
    ranked = placed.select("cell", "to_pivot").withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    return sizes.join(ranked.groupBy("cell").agg(F.sort_array(F.collect_list("to_pivot")).alias("nearest")), "cell")


def _light(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if fits(table, BROADCAST_CELLS) else table


def _salted(rows: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of cells with a salt, and `cells` (with `n`, the rows of each) once for each salt."""
    salts = F.ceil(F.col("n") / ROUTED).cast("int")
    counts = _light(cells.select("cell", salts.alias("salts")).distinct())
    dealt = rows.join(counts, "cell").withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int")).drop("salts")
    return dealt, cells.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))


def _split(placed: DataFrame, large: DataFrame, level: int, block_rows: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """The rows of `large` cells below pivots of their own; and these: cell, child, pivot."""
    wanted = F.least(F.lit(fan), F.ceil(F.col("n") / block_rows)).alias("wanted")
    draw = W.partitionBy("cell").orderBy(F.xxhash64("rep", F.lit(level)), "rep")
    # Ids alone are ranked; their vectors are fetched.
    drawn = placed.select("cell", "rep").withColumn("child", F.row_number().over(draw)).where(F.col("child") <= fan)
    drawn = materialise(drawn.join(_light(large.select("cell", wanted)), "cell").where("child <= wanted").select("rep", "child"))
    pivots = materialise(placed.join(_light(drawn), "rep").select("cell", "child", F.col("vector").alias("pivot")))
    rows, dealt = _salted(placed, pivots.join(_light(large.select("cell", "n")), "cell"))
    schema = "rep bigint, vector array<double>, cell string, to_pivot double"
    below = rows.groupBy("cell", "salt").cogroup(dealt.groupBy("cell", "salt")).applyInPandas(_assign_below, schema)
    rest = placed.join(_light(large.select("cell")), "cell", "left_anti").select("rep", "vector", "cell", "to_pivot")
    return materialise(rest.unionByName(below)), pivots


def _tree(groups: DataFrame, k: int, block_rows: int, fan: int):
    """Rows in leaves, the first level's pivots, and for each level below it the table of its nodes."""
    n = groups.count()
    wanted = max(1, min(fan, math.ceil(n / block_rows)))
    drawn = groups.orderBy(F.xxhash64("rep"), "rep").select("vector").limit(wanted).collect()
    pivots = np.array([r["vector"] for r in drawn], dtype=np.float64)
    schema = "rep bigint, vector array<double>, cell string, to_pivot double"
    placed = materialise(groups.select("rep", "vector").mapInPandas(_assign(pivots), schema))
    top = _nodes(placed, k).collect()  # as many as pivots
    large = placed.sparkSession.createDataFrame([(r["cell"], r["n"]) for r in top if r["n"] > SPLIT * block_rows], "cell string, n bigint")
    levels: list[DataFrame] = []
    while len(levels) < MAX_LEVELS and not large.isEmpty():
        placed, chosen = _split(placed, large, len(levels) + 1, block_rows, fan)
        names = chosen.select(F.col("cell").alias("parent"), F.concat_ws(".", "cell", F.col("child")).alias("cell"), "pivot")
        nodes = materialise(_nodes(placed, k).join(names, "cell"))
        levels.append(nodes)
        large = nodes.where(F.col("n") > SPLIT * block_rows).select("cell", "n")
    return placed, pivots, top, levels


def _distinct_edges(groups: DataFrame, k: int, block_rows: int, digits: int | None, fan: int, probes: int | None) -> DataFrame:
    """k nearest other vectors of every distinct vector."""
    placed, pivots, top, levels = _tree(groups, k, block_rows, fan)
    sizes = materialise(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))

    def search(queries: DataFrame) -> DataFrame:
        load = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("load"))
        return _search(queries, placed, sizes.join(load, "cell"), k, block_rows, digits)

    # At home first: the k-th neighbour found there keeps most rows from travelling.
    home = placed.select("rep", "vector", "cell", F.lit(float("inf")).alias("reach"))
    near = materialise(_closest(search(home), "rep", "other", k).drop("rank"))
    if len(pivots) == 1 and not levels:
        return _closest(near, "rep", "other", k)
    kth = near.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
    reach = F.when(F.col("n") == k, F.col("far")).otherwise(float("inf")).alias("reach")
    leaving = placed.join(kth, "rep", "left").select("rep", "vector", F.col("cell").alias("leaf"), reach)
    if probes is None:
        counts = np.zeros(len(pivots), int)
        for r in top:
            counts[int(r["cell"])] = r["n"]
        dealt, centres, _ = _teams(leaving, sizes, pivots, counts, block_rows)
        found = _exchanged(dealt, centres, k, digits)
        return _closest(near.unionByName(found), "rep", "other", k)
    radius, inner, nearest = np.full(len(pivots), -np.inf), np.full(len(pivots), np.inf), np.full((len(pivots), k + 1), np.inf)
    for r in top:
        at = int(r["cell"])
        radius[at], inner[at] = r["hi"], r["lo"]
        nearest[at, : len(r["nearest"])] = r["nearest"]
    names = np.array([str(c) for c in range(len(pivots))], dtype=object)
    visits = materialise(leaving.mapInPandas(_route(_Cells(pivots, radius, inner, nearest, k, probes), names), VISITS))
    for nodes in levels:
        load = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        below = nodes.withColumnRenamed("cell", "node").withColumnRenamed("parent", "cell").drop("n").join(_light(load), "cell")
        rows, dealt = _salted(visits, below)
        down = rows.groupBy("cell", "salt").cogroup(dealt.groupBy("cell", "salt")).applyInPandas(_route_below(k, probes), VISITS)
        ended = visits.join(_light(below.select("cell").distinct()), "cell", "left_anti").select(*visits.columns)
        visits = materialise(ended.unionByName(down))
    found = search(visits.select("rep", "vector", "cell", "reach"))
    return _closest(near.unionByName(found), "rep", "other", k)


def _search(queries: DataFrame, placed: DataFrame, loads: DataFrame, k: int, block_rows: int, digits: int | None) -> DataFrame:
    """Every row against the members of the leaf it visits, in blocks on both sides."""
    counts = [F.ceil(F.col(c) / block_rows).cast("int").alias(b) for c, b in (("n", "member_blocks"), ("load", "query_blocks"))]
    blocks = _light(materialise(loads.select("cell", *counts)))  # one row for each leaf

    def block(of: str) -> F.Column:
        return F.pmod(F.xxhash64("rep"), F.col(of)).cast("int")

    def every(of: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    visitors = queries.join(blocks, "cell").select(
        "rep", "vector", "reach", "cell", block("query_blocks").alias("qb"), every("member_blocks").alias("mb")
    )
    members = placed.join(blocks, "cell").select(
        F.col("rep").alias("other"),
        F.col("vector").alias("point"),
        F.col("cell").alias("c"),
        every("query_blocks").alias("q"),
        block("member_blocks").alias("m"),
    )
    return visitors.groupBy("cell", "qb", "mb").cogroup(members.groupBy("c", "q", "m")).applyInPandas(
        _best(k, digits), "rep bigint, other bigint, distance double"
    )


def knn_graph(
    df: DataFrame,
    row_id: str,
    vector: str,
    k: int = fixed.NEIGHBORS,
    metric: str = "euclidean",
    block_rows: int = BLOCK_ROWS,
    fan: int = MAX_PIVOTS,
    probes: int | None = None,
) -> DataFrame:
    """`row_id, neighbor, rank, distance`: the k nearest other rows; equal distances go by id.

    With `probes` the graph is approximate: beside its own leaf a row visits at most so
    many cells of every cell it comes to, those with the nearest pivots. Without, it is exact.
    """
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"Unknown metric: {metric}")
    data = df.where(F.col(vector).isNotNull()).select(
        F.col(row_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    if metric == "cosine":
        data = _unit(data)
    # The first k + 1 copies answer for all; the limit works before the shuffle, so a
    # vector shared by a third of the rows shrinks where it is read.
    copies = W.partitionBy("vector").orderBy("id")
    firsts = data.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1)
    groups = materialise(
        firsts.groupBy("vector").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("members"))
    )
    edges = _distinct_edges(groups, k, block_rows, 12 if metric == "cosine" else None, fan, probes)
    shared = groups.where(F.size("members") > 1)
    if shared.isEmpty():
        out = edges.select(F.col("rep").alias("id"), F.col("other").alias("neighbor"), "rank", "distance")
    else:
        out = _with_copies(data, materialise(edges), shared, k)
    if metric == "cosine":
        out = out.withColumn("distance", F.col("distance") * F.col("distance") / 2)
    return out.select(F.col("id").alias(row_id), "neighbor", "rank", "distance")


def _with_copies(data: DataFrame, edges: DataFrame, shared: DataFrame, k: int) -> DataFrame:
    """Edges between distinct vectors turned into edges between rows."""

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if fits(table, BROADCAST_COPIES) else table

    sets = shared.select(F.col("rep").alias("other"), "members")
    ids = F.coalesce("members", F.array("other"))
    spelled = edges.drop("rank").join(small(sets), "other", "left").select("rep", "distance", F.explode(ids).alias("neighbor"))
    spelled = _closest(spelled, "rep", "neighbor", k)
    own = small(shared.select("rep"))
    single = spelled.join(own, "rep", "left_anti").select(F.col("rep").alias("id"), "neighbor", "rank", "distance")

    # A copy's neighbours: the other copies, then what is near the shared vector.
    near = spelled.join(own, "rep", "left_semi").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("distance", "neighbor"))).alias("near")
    )
    none = F.array().cast("array<struct<distance:double,neighbor:bigint>>")
    twins = F.transform("members", lambda m: F.struct(F.lit(0.0).alias("distance"), m.alias("neighbor")))
    lists = shared.join(near, "rep", "left").select("vector", F.concat(twins, F.coalesce("near", none)).alias("near"))
    copied = data.join(small(lists), "vector").select(
        "id",
        F.posexplode(F.slice(F.filter("near", lambda e: e["neighbor"] != F.col("id")), 1, k)).alias("at", "edge"),
    ).select("id", "edge.neighbor", (F.col("at") + 1).alias("rank"), "edge.distance")
    return single.unionByName(copied)
