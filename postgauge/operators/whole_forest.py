"""A random forest of all its rows, whose trees are grown in tasks and never held by the driver.

Every feature is cut into bins by quantiles counted over all rows, and a row is a few bytes from
then on. A tree is grown level by level in one task, its nodes' counts summed by numpy; where a
tree has more than `UNIT_ROWS` rows its top is grown first, by counts summed over all tasks, and
the rows below each of its ends go to a task. How often a row is in a bag is a Poisson number from
a hash of its id and the bag. Counts are whole numbers, so a forest depends neither on the order of
its rows nor on their partitions. The rows left out of a bag are answered where its trees are grown.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.session import fresh_path, materialise

# Rows of a bag that a task grows a tree from.
UNIT_ROWS = 1_000_000
# Trees that share the rows of a task, where a task has all rows.
UNIT_TREES = 2
# Rows that travel together.
BLOCK_ROWS = 4096
# Nodes whose counts a task sums up at once.
NODES = 4096
# Bytes that a task hands to Python at once.
BATCH_BYTES = 8 << 20
_BLOCK = "block bigint, data binary"
_PART = "kind int, unit int, block bigint, tree int, data binary"
_MASK = (1 << 64) - 1


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Blocks are large rows, so fewer of them are handed over at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# --- bins -----------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of numbers in single precision; 0 has one sign, and NaN stands above all."""
    lengths = np.unique(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False))
    if len(lengths) != 1 or lengths[0] < 1:
        raise ValueError("every row needs a vector, all of one length")
    with np.errstate(over="ignore"):
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float32) + np.float32(0)
    x[np.isnan(x)] = np.nan
    return x


def _keys(x: np.ndarray) -> np.ndarray:
    """Numbers of 32 bits in the order of the values."""
    b = x.view(np.uint32)
    return np.where(b >> 31, ~b, b | np.uint32(1 << 31)).astype(np.int64)


def _value(key: int) -> float:
    b = np.uint32(key)
    return float((~b if not key >> 31 else b & np.uint32((1 << 31) - 1)).view(np.float32))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def _counts(rows: DataFrame, shift: int, chosen: np.ndarray | None, bins: int) -> DataFrame:
    """Stored rows (kind, key, n): how many values (kind 0) begin with the bits of `key`, below its feature's number.

    After the first round only those that begin with a chosen key count. The first adds the values themselves
    (kind 1) of features with at most `bins` of them in a task, and names the others (kind 2).
    """
    shared = rows.sparkSession.sparkContext.broadcast(chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, some, many, chosen = (np.zeros(0, np.int64),) * 2, np.zeros(0, np.int64), np.zeros(0, np.int64), shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            k = _keys(_matrix(batch.column(0)))
            keys, n = np.unique(k + (np.arange(k.shape[1]) << 32), return_counts=True)
            if chosen is None:
                some = np.union1d(some, keys[~np.isin(keys >> 32, many)])
                of, values = np.unique(some >> 32, return_counts=True)
                many = np.union1d(many, of[values > bins])
                some = some[~np.isin(some >> 32, many)]
            else:
                inside = np.isin(keys >> (shift + 8), chosen)
                keys, n = keys[inside], n[inside]
            held = _summed(np.concatenate([held[0], keys >> shift]), np.concatenate([held[1], n]))
        for kind, keys, n in ((0, *held), (1, some, some), (2, many, many)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"])

    parts = rows.select("features").mapInArrow(count, "kind int, key bigint, n bigint")
    return materialise(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")))


def thresholds(rows: DataFrame, bins: int) -> list[list[float]]:
    """For each feature at most `bins` - 1 values that cut it, by quantiles over all rows: the values themselves
    where there are few, else the values at their ranks, found in three rounds of counts."""
    counts = _counts(rows, 16, None, bins)
    many = {r["key"] for r in counts.where("kind = 2").collect()}
    values = counts.where("kind = 1").withColumn("feature", F.shiftright("key", 32))
    several = values.groupBy("feature").agg(F.count("key").alias("n")).collect()
    few = {r["feature"] for r in several if r["n"] <= bins} - many
    cuts: dict[int, set[int]] = {f: set() for f in many | {r["feature"] for r in several}}
    for r in values.where(F.col("feature").isin(*few)).select("key").collect() if few else []:
        cuts[r["key"] >> 32].add(r["key"] & 0xFFFFFFFF)
    prefix = rank = None
    for shift, bits in ((16, 16), (8, 8), (0, 8)):
        if shift < 16:
            counts = _counts(rows, shift, np.unique(prefix), bins)
        table = counts.where("kind = 0").orderBy("key").select("key", "n").toArrow()
        keys, n = (table[c].to_numpy() for c in ("key", "n"))
        upto = np.cumsum(n)
        if prefix is None:
            wanted = np.array(sorted(set(cuts) - few), dtype=np.int64)
            if not len(wanted):
                break
            sizes = np.array([n[keys >> 16 == f].sum() for f in wanted])
            rank = (-(-sizes[:, None] * np.arange(1, bins) // bins) - 1).ravel()  # as many lie below or on it as its share says
            prefix = np.repeat(wanted, bins - 1)
        before = np.concatenate([[0], upto])
        place = rank + before[np.searchsorted(keys, prefix << bits)]
        at = np.searchsorted(upto, place, side="right")
        prefix, rank = keys[at], place - before[at]
    else:
        for key in np.unique(prefix).tolist():
            cuts[key >> 32].add(key & 0xFFFFFFFF)
    found = ({_value(k) for k in cuts[f]} for f in sorted(cuts))
    return [sorted(v for v in values if not math.isnan(v))[: bins - 1] for values in found]  # above the last there are others, or none


class Block(NamedTuple):
    """Rows as they travel: id, hash, label, where they enter their trees, and a byte for each feature's bin."""

    row: np.ndarray
    hash: np.ndarray
    label: np.ndarray
    at: np.ndarray
    bins: np.ndarray

    def packed(self) -> bytes:
        return b"".join(np.ascontiguousarray(a).tobytes() for a in self)

    def some(self, chosen: np.ndarray, at: np.ndarray) -> Block:
        return Block(self.row[chosen], self.hash[chosen], self.label[chosen], at.astype(np.int32), self.bins[chosen])

    @staticmethod
    def of(data: bytes, width: int) -> Block:
        n, arrays, begin = len(data) // (21 + width), [], 0
        for kind, size in ((np.int64, n), (np.int64, n), (np.uint8, n), (np.int32, n), (np.uint8, n * width)):
            arrays.append(np.frombuffer(data, kind, size, begin))
            begin += arrays[-1].nbytes
        return Block(*arrays[:4], arrays[4].reshape(n, width))

    @staticmethod
    def joined(blocks: list[Block]) -> Block:
        return Block(*(np.concatenate(parts) for parts in zip(*blocks, strict=True)))


def binned(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """Rows (row, hash, label, features) as blocks, each named by its first row."""
    cuts = [np.array(c, dtype=np.float32) for c in cuts]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, BLOCK_ROWS):
                row, hashed, label, features = whole.slice(begin, BLOCK_ROWS).columns
                x, label = _matrix(features), label.fill_null(-1).to_numpy(zero_copy_only=False)
                if x.shape[1] != len(cuts) or not np.isin(label, (0, 1)).all():
                    raise ValueError("labels are 0 or 1, and vectors as long as those of the fit")
                bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
                row, hashed = (a.to_numpy(zero_copy_only=False) for a in (row, hashed))
                data = Block(row, hashed, label.astype(np.uint8), np.zeros(len(row), np.int32), bins).packed()
                yield pa.RecordBatch.from_arrays([pa.array(row[:1]), pa.array([data], pa.binary())], ["block", "data"])

    return rows.mapInArrow(cut, _BLOCK)


# --- trees ----------------------------------------------------------------

class Nodes(NamedTuple):
    """Nodes of trees, their roots first. Rows whose bin is above the node's go to the child after `left`;
    an end has no feature (-1) and the share of class 1."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    share: np.ndarray

    def ends(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The end that each row comes to from where it enters."""
        at, live = at.astype(np.int64), np.arange(len(at))
        while len(live):
            live = live[self.feature[at[live]] >= 0]
            node = at[live]
            at[live] = self.left[node] + (bins[live, self.feature[node]] > self.bin[node])
        return at

    def packed(self) -> bytes:
        return b"".join(a.astype(kind).tobytes() for a, kind in zip(self, _KINDS, strict=True))

    @staticmethod
    def of(data: bytes) -> Nodes:
        n, arrays, begin = len(data) // sum(k.itemsize for k in _KINDS), [], 0
        for kind in _KINDS:
            arrays.append(np.frombuffer(data, kind, n, begin))
            begin += arrays[-1].nbytes
        return Nodes(*arrays)


_KINDS = [np.dtype(k) for k in (np.int32, np.uint8, np.int32, np.float64)]


@dataclass(frozen=True)
class Growth:
    """How trees are grown: features tried at a node, the deepest level, the least rows of a child, the weights of
    both classes, and the bins of a feature."""

    tried: int
    deepest: int
    least: int
    weights: tuple[float, float]
    bins: int
    seed: int


def chosen_features(draw: np.random.Generator, nodes: int, width: int, tried: int) -> np.ndarray:
    """`tried` different features for each node."""
    if tried >= width:
        return np.tile(np.arange(width), (nodes, 1))
    order, each = np.tile(np.arange(width, dtype=np.int32), (nodes, 1)), np.arange(nodes)
    for i in range(tried):
        j = i + (draw.random(nodes) * (width - i)).astype(np.int64)
        picked = order[each, j]
        order[each, j] = order[:, i]
        order[:, i] = picked
    return order[:, :tried]


def _impurity(zeros: np.ndarray, ones: np.ndarray, how: Growth) -> np.ndarray:
    """Half the Gini impurity times the weight, from rows of both classes."""
    a, b = zeros * how.weights[0], ones * how.weights[1]
    return a * b / np.maximum(a + b, 1e-300)


def best_cuts(counts: Iterator[np.ndarray], features: np.ndarray, totals: np.ndarray, how: Growth):
    """For each node the feature, the bin and the rows of its left child, by the counts (node, bin, class) of one
    tried feature after another; the feature is -1 where nothing is gained."""
    each, whole = np.arange(len(totals)), _impurity(totals[:, 0], totals[:, 1], how)
    least = whole * (1 - 1e-10)
    feature, cut, left = np.full(len(totals), -1, np.int32), np.zeros(len(totals), np.uint8), np.zeros_like(totals)
    for i, n in enumerate(counts):
        below = n.cumsum(axis=1)[:, :-1]
        a, b = below[..., 0], below[..., 1]
        c, d = totals[:, :1] - a, totals[:, 1:] - b
        mixed = _impurity(a, b, how) + _impurity(c, d, how)
        if how.least > 1:
            mixed = np.where((a + b >= how.least) & (c + d >= how.least), mixed, np.inf)
        at = mixed.argmin(axis=1)
        value = mixed[each, at]
        better = value < least
        least = np.where(better, value, least)
        feature[better], cut[better], left[better] = features[better, i], at[better], below[each, at][better]
    return feature, cut, left


def _open(totals: np.ndarray, depths: np.ndarray, how: Growth) -> np.ndarray:
    """Nodes that may be cut."""
    return (totals > 0).all(axis=1) & (depths < how.deepest) & (totals.sum(axis=1) >= 2 * how.least)


def _class_counts(key: np.ndarray, weight: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    return np.bincount(key, weight, nodes * bins * 2).reshape(nodes, bins, 2)


def grow_nodes(block: Block, weight: np.ndarray, depths: np.ndarray, how: Growth, draw: np.random.Generator) -> Nodes:
    """Trees below roots at `depths`, from the block's rows, each so many times."""
    inside = np.flatnonzero(weight)
    weight, label = weight[inside], block.label[inside].astype(np.int64)
    node, levels, first = block.at[inside].astype(np.int64), [], 0
    totals = np.bincount(node * 2 + label, weight, 2 * len(depths)).reshape(-1, 2)
    while len(totals):
        feature, cut, left = np.full(len(totals), -1, np.int32), np.zeros(len(totals), np.uint8), np.zeros((len(totals), 2))
        live = np.flatnonzero(_open(totals, depths, how))
        number = np.full(len(totals), -1)
        number[live] = np.arange(len(live))
        kept = np.flatnonzero(number[node] >= 0)
        kept = kept[np.argsort(number[node[kept]], kind="stable")]
        inside, weight, label, node = inside[kept], weight[kept], label[kept], number[node[kept]]
        for begin in range(0, len(live), NODES):
            some = live[begin : begin + NODES]
            here = slice(*np.searchsorted(node, (begin, begin + len(some))))
            of, rows, key = node[here] - begin, inside[here], (node[here] - begin) * (2 * how.bins) + label[here]
            features = chosen_features(draw, len(some), block.bins.shape[1], how.tried)
            tried = (_class_counts(key + 2 * block.bins[rows, features[of, i]].astype(np.int64), weight[here], len(some), how.bins) for i in range(how.tried))
            feature[some], cut[some], left[some] = best_cuts(tried, features, totals[some], how)
        split = np.flatnonzero(feature >= 0)
        child = np.full(len(totals), -1)
        child[split] = 2 * np.arange(len(split))
        a, b = totals[:, 0] * how.weights[0], totals[:, 1] * how.weights[1]
        levels.append(Nodes(feature, cut, np.where(child >= 0, first + len(totals) + child, -1), b / np.maximum(a + b, 1e-300)))
        first += len(totals)
        of = live[node]
        kept = np.flatnonzero(child[of] >= 0)
        inside, weight, label, of = inside[kept], weight[kept], label[kept], of[kept]
        node = child[of] + (block.bins[inside, feature[of]] > cut[of])
        totals = np.stack([left[split], totals[split] - left[split]], axis=1).reshape(-1, 2)
        depths = np.repeat(depths[split] + 1, 2)
    return Nodes(*(np.concatenate(parts) for parts in zip(*levels, strict=True)))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(17)])


def bag_counts(hashes: np.ndarray, bag: int) -> np.ndarray:
    """How often a row is in the bag: a Poisson number of mean 1, by its hash."""
    with np.errstate(over="ignore"):
        z = hashes.view(np.uint64) + np.uint64((bag + 1) * 0x9E3779B97F4A7C15 & _MASK)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return np.searchsorted(_POISSON, (z >> np.uint64(11)) / float(1 << 53), side="right").astype(np.float64)


# --- forests --------------------------------------------------------------

@dataclass
class Top:
    """The nodes of a tree that are grown by all tasks; for each end the unit its rows go to, and which of that unit's roots."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    unit: list[int] = field(default_factory=lambda: [0])
    root: list[int] = field(default_factory=lambda: [0])

    def nodes(self) -> Nodes:
        return Nodes(*(np.array(a) for a in (self.feature, self.bin, self.left, self.root)))


@dataclass
class Plan:
    """What routes rows: cuts of the features, tops of the trees, the trees of each unit and the depths of its roots.

    A unit of `closed` ones has a root that was grown to its end with all rows, and this share."""

    cuts: list[list[float]]
    tops: list[Top]
    trees: list[list[int]]
    depths: list[list[int]]
    closed: dict[int, float] = field(default_factory=dict)

    def stored(self) -> str:
        return json.dumps([self.cuts, [vars(t) for t in self.tops], self.trees, self.depths, list(self.closed.items())])

    @staticmethod
    def of(stored: str) -> Plan:
        cuts, tops, trees, depths, closed = json.loads(stored)
        return Plan(cuts, [Top(**t) for t in tops], trees, depths, dict(map(tuple, closed)))


def _bag(tree: int, per_bag: int | None, hashes: np.ndarray) -> np.ndarray:
    return np.ones(len(hashes)) if per_bag is None else bag_counts(hashes, tree // per_bag)


def _draw(how: Growth, *of: int) -> np.random.Generator:
    return np.random.default_rng([how.seed & _MASK, *of])


def _grow_tops(blocks: DataFrame, width: int, trees: int, per_bag: int | None, how: Growth) -> tuple[list[Top], list[dict[int, list[float]]]]:
    """Tops down to ends of at most `UNIT_ROWS` rows of a bag, and each end's rows of both classes. An end with
    more of them can't be cut."""
    spark = blocks.sparkSession
    tops, ends = [Top() for _ in range(trees)], [{} for _ in range(trees)]
    waiting: list[tuple[int, int]] = []  # tree, node

    def sums(asked: list[tuple[int, int]], cut: bool) -> Iterator[tuple]:
        """Rows (tree, node, zeros, ones, feature, bin, zeros and ones of the left child)."""
        by_tree: dict[int, list[int]] = {}
        for tree, node in asked:
            by_tree.setdefault(tree, []).append(node)
        known = {(t, n): ends[t][n] for t, n in asked} if cut else {}
        shared = spark.sparkContext.broadcast(({t: (tuple(tops[t].nodes()), nodes) for t, nodes in by_tree.items()}, known))

        def features(tree: int, nodes: list[int]) -> np.ndarray:
            return np.concatenate([chosen_features(_draw(how, tree, 1, n), 1, width, how.tried) for n in nodes])

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, counts = shared.value[0], {}
            for batch in batches:
                for data in batch.column(1):
                    block = Block.of(data.as_py(), width)
                    for tree, (top, nodes) in trees.items():
                        top = Nodes(*top)
                        number = np.full(len(top.feature), -1)
                        number[nodes] = np.arange(len(nodes))
                        of, weight = number[top.ends(block.bins, block.at)], _bag(tree, per_bag, block.hash)
                        rows = np.flatnonzero((of >= 0) & (weight > 0))
                        of, weight, label = of[rows], weight[rows], block.label[rows].astype(np.int64)
                        if cut:
                            tried, key = features(tree, nodes), of * (2 * how.bins) + label
                            found = [_class_counts(key + 2 * block.bins[rows, tried[of, i]].astype(np.int64), weight, len(nodes), how.bins) for i in range(how.tried)]
                        else:
                            found = [_class_counts(of * 2 + label, weight, len(nodes), 1)]
                        counts[tree] = counts.get(tree, 0) + np.stack(found)
            for tree, found in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["tree", "data"])

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (trees, known), counts = shared.value, {}
            for batch in batches:
                for tree, data in zip(*batch.columns, strict=True):
                    t = tree.as_py()
                    counts[t] = counts.get(t, 0) + np.frombuffer(data.as_py())
            for t, found in counts.items():
                nodes = trees[t][1]
                if cut:
                    found, totals = found.reshape(how.tried, len(nodes), how.bins, 2), np.array([known[t, n] for n in nodes])
                    feature, at, left = best_cuts(iter(found), features(t, nodes), totals, how)
                else:
                    totals, feature, at, left = found.reshape(-1, 2), np.full(len(nodes), -1), np.zeros(len(nodes)), np.zeros((len(nodes), 2))
                columns = [np.full(len(nodes), t), np.array(nodes), feature, at, *totals.T, *left.T]
                arrays = [pa.array(c.astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["tree", "node", "feature", "bin", "zeros", "ones", "left_zeros", "left_ones"])

        parts = blocks.mapInArrow(count, "tree int, data binary").repartitionById(trees, "tree")
        schema = "tree bigint, node bigint, feature bigint, bin bigint, zeros bigint, ones bigint, left_zeros bigint, left_ones bigint"
        return (tuple(r) for r in parts.mapInArrow(choose, schema).collect())  # a row for each node that is asked for

    def wait(tree: int, node: int) -> None:
        totals = np.array([ends[tree][node]], dtype=float)
        if totals.sum() > UNIT_ROWS and _open(totals, np.array([tops[tree].depth[node]]), how)[0]:
            waiting.append((tree, node))

    for tree, node, _, _, zeros, ones, *_ in sums([(t, 0) for t in range(trees)], False):
        ends[tree][node] = [zeros, ones]
        wait(tree, node)
    while waiting:
        asked, waiting[:] = sorted(waiting[:NODES]), waiting[NODES:]
        for tree, node, feature, at, zeros, ones, *left in sorted(sums(asked, True)):
            if feature >= 0:
                top, first = tops[tree], len(tops[tree].feature)
                top.feature[node], top.bin[node], top.left[node] = feature, at, first
                for child, rows in enumerate((left, [zeros - left[0], ones - left[1]])):
                    for name, value in (("feature", -1), ("bin", 0), ("left", -1), ("depth", top.depth[node] + 1), ("unit", 0), ("root", 0)):
                        getattr(top, name).append(value)
                    ends[tree][first + child] = rows
                    wait(tree, first + child)
                del ends[tree][node]
    return tops, ends


def _planned(blocks: DataFrame, cuts: list[list[float]], rows: int, trees: int, per_bag: int | None, how: Growth) -> Plan:
    if rows <= UNIT_ROWS:
        lots = [list(range(at, min(at + UNIT_TREES, trees))) for at in range(0, trees, UNIT_TREES)]
        return Plan(cuts, [Top(unit=[t // UNIT_TREES]) for t in range(trees)], lots, [[0]] * len(lots))
    tops, ends = _grow_tops(blocks, len(cuts), trees, per_bag, how)
    plan = Plan(cuts, tops, [], [])
    for tree, top in enumerate(tops):
        held = math.inf
        for node in sorted(ends[tree]):
            zeros, ones = ends[tree][node]
            closed = zeros + ones > UNIT_ROWS
            if closed or held + zeros + ones > UNIT_ROWS:
                plan.trees.append([tree])
                plan.depths.append([])
                held = math.inf if closed else 0
            if closed:
                a, b = zeros * how.weights[0], ones * how.weights[1]
                plan.closed[len(plan.trees) - 1] = b / (a + b)
            held += zeros + ones
            top.unit[node], top.root[node] = len(plan.trees) - 1, len(plan.depths[-1])
            plan.depths[-1].append(top.depth[node])
    return plan


def _part(kind: int, unit: int, block: int, tree: int, data: bytes) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
    values = [pa.array([v], t) for v, t in zip((kind, unit, block, tree, data), types, strict=True)]
    return pa.RecordBatch.from_arrays(values, ["kind", "unit", "block", "tree", "data"])


def _routed(blocks: DataFrame, plan: Plan) -> DataFrame:
    """The rows of every block for each unit they go to."""
    width, tops = len(plan.cuts), {tuple(t.unit): t for t in plan.tops}.values()  # trees of one unit go the same way
    shared = blocks.sparkSession.sparkContext.broadcast([(tuple(t.nodes()), np.array(t.unit)) for t in tops])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [(Nodes(*top), units) for top, units in shared.value]
        for batch in batches:
            for name, data in zip(*batch.columns, strict=True):
                data = data.as_py()
                block = Block.of(data, width)
                for top, units in tops:
                    if len(units) == 1:
                        parts = [(int(units[0]), data)]
                    else:
                        end = top.ends(block.bins, block.at)
                        to, root = units[end], top.share[end]
                        parts = [(int(u), block.some(to == u, root[to == u]).packed()) for u in np.unique(to)]
                    for unit, part in parts:
                        yield _part(1, unit, name.as_py(), 0, part)

    return blocks.mapInArrow(route, _PART)


def _votes(row: np.ndarray, ones: np.ndarray, trees: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in (row, ones, trees))


def _grown(blocks: DataFrame, plan: Plan, per_bag: int | None, how: Growth, score: bool) -> DataFrame:
    """Rows of kind 0, the trees of a unit, and with `score` of kind 1, the votes for rows outside of their bags."""
    width, shared = len(plan.cuts), blocks.sparkSession.sparkContext.broadcast((plan.trees, plan.depths, plan.closed))

    def votes(unit: int, row: np.ndarray, name: int, shares: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        ones, trees = np.zeros(len(row)), np.zeros(len(row))
        for weight, share in shares:
            ones += np.where(weight == 0, share, 0)
            trees += weight == 0
        out = trees > 0
        if out.any():
            yield _part(1, unit, name, 0, _votes(row[out], ones[out], trees[out]))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (of_unit, depths, closed), held = shared.value, {}
        for batch in batches:
            for _, unit, name, _, data in zip(*batch.columns, strict=True):
                unit, name, block = unit.as_py(), name.as_py(), Block.of(data.as_py(), width)
                if unit not in closed:
                    held.setdefault(unit, []).append((name, block))
                elif score:
                    weight = _bag(of_unit[unit][0], per_bag, block.hash)
                    yield from votes(unit, block.row, name, [(weight, np.full(len(weight), closed[unit]))])
        for unit, parts in held.items():
            parts.sort(key=lambda p: p[0])
            whole, sizes, shares = Block.joined([b for _, b in parts]), [(name, len(b.row)) for name, b in parts], []
            parts.clear()  # the same rows once more
            for tree in of_unit[unit]:
                weight = _bag(tree, per_bag, whole.hash)
                nodes = grow_nodes(whole, weight, np.array(depths[unit]), how, _draw(how, tree, 0, unit))
                yield _part(0, unit, 0, tree, nodes.packed())
                if score:
                    out, share = np.flatnonzero(weight == 0), np.zeros(len(weight))
                    share[out] = nodes.share[nodes.ends(whole.bins[out], whole.at[out])]
                    shares.append((weight, share))
            at = 0
            for name, n in sizes if score else ():
                here = slice(at, at := at + n)
                yield from votes(unit, whole.row[here], name, [(w[here], s[here]) for w, s in shares])

    return _routed(blocks, plan).repartitionById(len(plan.trees), "unit").mapInArrow(grow, _PART)


def _counted_votes(votes: DataFrame) -> DataFrame:
    """Rows (row, ones, trees): the sums of each row's votes, added in the order of units."""
    width = max(1, int(votes.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))

    def total(parts: list[bytes]) -> pa.RecordBatch:
        arrays = [[np.frombuffer(p, kind, len(p) // 24, at * (len(p) // 24) * 8) for p in parts] for at, kind in enumerate((np.int64, np.float64, np.float64))]
        row, ones, trees = map(np.concatenate, arrays)
        row, at = np.unique(row, return_inverse=True)
        sums = (pa.array(np.bincount(at, x, len(row))) for x in (ones, trees))
        return pa.RecordBatch.from_arrays([pa.array(row), *sums], ["row", "ones", "trees"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for name, _, data in zip(*batch.columns, strict=True):
                if held and name.as_py() != last:
                    yield total(held)
                    held = []
                last = name.as_py()
                held.append(data.as_py())
        if held:
            yield total(held)

    dealt = votes.select("block", "unit", "data").repartition(width, "block").sortWithinPartitions("block", "unit")
    return dealt.mapInArrow(add, "row bigint, ones double, trees double")


class WholeForest(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """A forest whose trees are rows of a table. Adds the class with the larger sum of all trees' shares, ties going to
    class 0. A transform runs at once, the trees in tasks of their own, and stores its rows."""

    def __init__(self, plan: str = "", path: str = "", features: str = "features", prediction: str = "prediction"):
        super().__init__()
        self.plan, self.path = plan, path
        self._set(featuresCol=features, predictionCol=prediction)

    def getNumTrees(self) -> int:
        return len(Plan.of(self.plan).tops)

    def _transform(self, df: DataFrame) -> DataFrame:
        spark, plan, row = df.sparkSession, Plan.of(self.plan), fresh_path(df.sparkSession, "row").rsplit("/", 1)[1].replace("-", "_")
        width, shared = len(plan.cuts), spark.sparkContext.broadcast(plan.closed)
        stored = materialise(df.withColumn(row, F.monotonically_increasing_id()))
        asked = stored.select(F.col(row).alias("row"), F.lit(0).cast("bigint").alias("hash"), F.lit(0).alias("label"), vector_to_array(self.getFeaturesCol()).alias("features"))

        def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes, unit = [], None
            for batch in batches:
                for kind, of, name, _, data in zip(*batch.columns, strict=True):
                    if of.as_py() != unit:
                        nodes, unit = [], of.as_py()
                    if kind.as_py() == 0:
                        nodes.append(Nodes.of(data.as_py()))
                        continue
                    block = Block.of(data.as_py(), width)
                    shares = [n.share[n.ends(block.bins, block.at)] for n in nodes] or [np.full(len(block.row), shared.value[unit])]
                    yield _part(1, unit, name.as_py(), 0, _votes(block.row, sum(shares), np.full(len(block.row), float(len(shares)))))

        parts = spark.read.parquet(self.path).unionByName(_routed(binned(asked, plan.cuts), plan))
        dealt = parts.repartitionById(len(plan.trees), "unit").sortWithinPartitions("unit", "kind", "tree", "block")
        votes = _counted_votes(dealt.mapInArrow(vote, _PART))
        predicted = votes.select(F.col("row").alias(row), (2 * F.col("ones") > F.col("trees")).cast("double").alias(self.getPredictionCol()))
        with small_batches(spark):
            predicted = materialise(predicted)
        return stored.join(predicted, row).drop(row)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, forest: WholeForest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.forest, path, self.sparkSession, {"plan": self.forest.plan})
        self.sparkSession.read.parquet(self.forest.path).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> WholeForest:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        forest = WholeForest(metadata["plan"], f"{path}/trees")
        forest._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(forest, metadata)
        return forest


def grow_whole(
    data: DataFrame,
    grower: RandomForestClassifier,
    row_id: str | None,
    weights: dict[int, float],
    bagged: bool = True,
    per_bag: int = 1,
    score: bool = False,
) -> tuple[WholeForest, DataFrame | None]:
    """As many trees as `grower` asks for, by its other settings, from all stored rows of `data`; with `score` also
    rows (row, ones, trees), named by `data`'s column `_row`: the answers of trees whose bags a row is out of.

    Without a row id the rows count as different by their places; rows with the same id are in the same bags.
    """
    spark: SparkSession = data.sparkSession
    seed = grower.getSeed()
    hashed = F.xxhash64(row_id or "_row", F.lit(seed)).alias("hash")
    features = vector_to_array(grower.getFeaturesCol()).alias("features")
    rows = data.select(F.col("_row").alias("row"), hashed, F.col(grower.getLabelCol()).cast("int").alias("label"), features)
    trees, bins = grower.getNumTrees(), grower.getMaxBins()
    per_bag = per_bag if bagged else None
    path = fresh_path(spark, "trees")
    with small_batches(spark):
        cuts = thresholds(rows, bins)
        tried = len(cuts) if trees == 1 else math.ceil(math.sqrt(len(cuts)))  # as Spark's forest does
        how = Growth(tried, grower.getMaxDepth(), grower.getMinInstancesPerNode(), (weights.get(0, 1.0), weights.get(1, 1.0)), bins, seed)
        blocks = materialise(binned(rows, cuts))
        plan = _planned(blocks, cuts, data.count(), trees, per_bag, how)
        grown = materialise(_grown(blocks, plan, per_bag, how, score))
        grown.where("kind = 0").write.parquet(path)
        votes = materialise(_counted_votes(grown.where("kind = 1"))) if score else None
    return WholeForest(plan.stored(), path, grower.getFeaturesCol(), grower.getPredictionCol()), votes
