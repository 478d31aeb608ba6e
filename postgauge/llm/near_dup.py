"""Near duplicates by bottom-k sketches, estimated on union sketches and verified exactly.

One hash function gives every word shingle a number; a document keeps its k smallest numbers.
Documents with equal shingle sets become one node first. Inverted lists are keyed by runs of
`RUN` neighbouring retained values rather than by single ones: two sets that are nearly
equal agree on such runs almost everywhere, while a passage that many documents share fills
a whole run only where little else is in the document. Lists name the overlapping pairs:

1. In every list each node is paired with the list's smallest node, never all with all.
   Pairs that pass the union-sketch estimate are verified on full shingle sets; the links
   give components.
2. Lists that still hold several components are searched for links between these: short ones
   pair by pair with estimate and verification, long ones in blocks on full sets.

So every pair of a list is either linked, estimated apart, verified, or inside one component
already: copies cost one pair per copy. A link that joins two components is lost only where
the estimate falls `SLACK` standard deviations short: for a pair right at the threshold and
sketches of 64 values with a chance of 9e-12 at 85 percent, of 1e-12 at 80.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.llm.tables import map_beside, materialise, small

WORDS = 5  # in a shingle
KEPT = 64  # values in a sketch
RUN = 4  # neighbouring values in a key
LEAST_PERCENT = 80  # below it large sets could share no run
SLACK = 8.0  # standard deviations by which an estimate may fall short
SHORT_LIST = 64  # entries of a list that is searched where it lies
BLOCK = 256  # nodes that are compared at once with as many others
# Letters A-Z become lower case and ASCII white space parts words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class WordHash(dict):
    """64-bit numbers of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word)
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = number
        return number


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, numbers: WordHash) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of five words.

    With fewer words the whole sequence is the only shingle; without words there is none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split(b" ")
    found = [w for w in found if w]
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(numbers.__getitem__, found), np.uint64, len(found))
    width = min(WORDS, len(found))
    rolled = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        rolled += _mixed(hashes[k : len(hashes) - width + 1 + k] * _ODD[k] + np.uint64(k + 1))
    return np.unique(_mixed(rolled))


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, n (size of the shingle set), its digest, and the k smallest hashes."""

    def start():
        numbers = WordHash()

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            sets = [shingles(x.as_py(), numbers) for x in columns[1]]
            return [
                columns[0],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([s[:KEPT].astype("<u8").tobytes() for s in sets], pa.binary()),
            ]

        return work

    inputs = [F.col(doc_id).cast("bigint"), F.col(text)]
    return map_beside(docs, inputs, start, "doc_id bigint, n bigint, digest binary, sketch binary", carry=[]).drop("row")


def run_widths(size: int, percent: int) -> list[int]:
    """Lengths of the runs that give a set of `size` its keys.

    With c values in both of two sets and d in one of them only, the c values lie in at most
    d + 1 unbroken runs, so the longest has at least c / (d + 1). That length is a width for
    both sets, for every c and d that make them similar enough; a small set with none can't
    be similar to a different one. Longer runs are keyed by `RUN` values.
    """
    if size > KEPT:
        return [RUN]
    widths = set()
    for both in range(1, size + 1):
        for apart in range(max(1, size - both), both * (100 - percent) // percent + 1):
            widths.add(min(RUN, -(-both // (apart + 1))))
    return sorted(widths)


def keys(nodes: DataFrame, percent: int) -> DataFrame:
    """Inverted-list entries: key, node, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths = [run_widths(size, percent) for size in range(KEPT + 2)]
        for batch in batches:
            node, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows, counts = [], []
            for sketch, size in zip(batch.column(2), n, strict=True):
                made = run_keys(np.frombuffer(sketch.as_py(), "<u8"), widths[min(size, KEPT + 1)])
                rows.append(made)
                counts.append(len(made))
            if sum(counts):
                columns = [np.concatenate(rows).view(np.int64), np.repeat(node, counts), np.repeat(n, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "n"])

    return nodes.select("node", "n", "sketch").mapInArrow(run, "key bigint, node bigint, n bigint")


def run_keys(sketch: np.ndarray, widths: list[int]) -> np.ndarray:
    """One number for every run of neighbouring values."""
    made = [np.empty(0, np.uint64)]
    for width in widths:
        rolled = np.full(len(sketch) - width + 1, width, np.uint64)
        for k in range(width):
            rolled += _mixed(sketch[k : len(sketch) - width + 1 + k] * _ODD[k] + np.uint64(k + 1))
        made.append(rolled)
    return np.unique(np.concatenate(made))


def least_estimate(similarity: float, size: int) -> float:
    """The estimate that a pair at `similarity` falls below with negligible chance."""
    return similarity - SLACK * math.sqrt(similarity * (1 - similarity) / size)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[float, int]:
    """Similarity in the sketch of the union: the share of its values that both sets hold.

    Also how many values that sketch has; it is the whole union if both sets are small.
    """
    union = np.union1d(a, b)
    if len(a) == KEPT or len(b) == KEPT:
        union = union[:KEPT]
    both = np.intersect1d(a, b, assume_unique=True)
    return np.searchsorted(both, union[-1], side="right") / len(union), len(union)


def passes(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    found, size = estimate(a, b)
    return found >= least_estimate(similarity, size)


def _sizes_fit(a, b, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the estimate on their sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                passes(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), percent / 100)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    one = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "sketch_a", "sketch_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def _sets(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, shingles) of the nodes in `wanted`: a node is the id of a document that has its
    set, and only the texts of these documents are read into sets again."""

    def start():
        numbers = WordHash()

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            return [columns[0], pa.array([shingles(x.as_py(), numbers).tobytes() for x in columns[1]], pa.binary())]

        return work

    texts = docs.select(F.col(doc_id).cast("bigint").alias("node"), F.col(text).alias("text"))
    texts = texts.join(small(materialise(wanted)), "node", "left_semi")
    inputs = [F.col("node"), F.col("text")]
    sets = map_beside(texts, inputs, start, "node bigint, shingles binary", carry=[]).drop("row")
    return materialise(sets.groupBy("node").agg(F.first("shingles").alias("shingles")))


def _verified(pairs: DataFrame, docs: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets(wanted, docs, doc_id, text)
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return both.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for every node in a link.

    Alternates large stars (each larger neighbour of a node is linked to the node's smallest
    neighbour) and small stars (the same for smaller neighbours); path lengths shrink by half
    or more, and a centre with many neighbours sends one row for each. Every round is stored.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialise(ordered.distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_star = large.join(smallest(large), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(small_star.unionByName(smallest(large).withColumnRenamed("m", "v")).distinct())
        if _digest(after) == _digest(edges):
            # Every node now points at the smallest node of its component.
            roots = after.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            return materialise(after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots))
        edges = after


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _open_lists(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries (key, node, n, component, c) of the lists that hold several components."""
    labelled = members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    open_ = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c"))
    return materialise(labelled.join(open_.where("lo <> hi").select("key", "c"), "key"))


def _short_list_pairs(held: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of nodes that share a short list and lie in different components."""
    entry = F.struct("node", "n", "component").alias("x")
    short = held.where(F.col("c") <= SHORT_LIST).groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("xs"))

    def partners(x, i):
        later = F.slice("xs", i + 2, F.size("xs"))
        fits = F.filter(later, lambda y: (y["component"] != x["component"]) & _sizes_fit(x["n"], y["n"], percent))
        return F.transform(fits, lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))

    return short.select(F.explode(F.flatten(F.transform("xs", partners))).alias("p")).select("p.a", "p.b").distinct()


def _long_list_links(held: DataFrame, docs: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    """Links between components whose nodes share a long list.

    Lists that share nodes form a cluster, so that two nodes meet once and not once a list. A
    cluster is cut into blocks, large components into blocks of their own; every two blocks that
    are not of one component meet in a task, with full shingle sets. A task counts all its
    intersections by products of incidence matrices and returns links that join components it
    has not yet joined: fewer rows than it has nodes, whatever the number of similar pairs.
    """
    long = materialise(held.where(F.col("c") > SHORT_LIST).select("key", "node", "n", "component"))
    if long.isEmpty():
        return docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    heads = long.groupBy("key").agg(F.min("node").alias("head"))
    clusters = components(long.join(heads, "key").select(F.col("head").alias("a"), F.col("node").alias("b")))
    placed = long.select("node", "n", "component").distinct().join(clusters.withColumnRenamed("component", "cluster"), "node")
    placed = materialise(placed)
    sizes = placed.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("c"))
    rest = sizes.groupBy("cluster").agg(F.ceil(F.sum(F.when(F.col("c") < BLOCK, F.col("c")).otherwise(0)) / BLOCK).alias("mixed"))
    own = F.concat_ws("-", "component", F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / BLOCK)))
    shared = F.concat(F.lit("m"), F.pmod(F.xxhash64("component"), F.greatest("mixed", F.lit(1))))
    large = F.col("c") >= BLOCK
    dealt = placed.join(sizes, ["cluster", "component"]).join(rest, "cluster")
    dealt = dealt.select(
        "cluster", "node", "n", "component",
        F.when(large, own).otherwise(shared).alias("block"), F.when(large, F.col("component")).alias("only"),
    )
    dealt = materialise(dealt)
    blocks = dealt.select("cluster", "block", "only").distinct()
    one = blocks.select("cluster", F.col("block").alias("i"), F.col("only").alias("in_i"))
    two = blocks.select("cluster", F.col("block").alias("j"), F.col("only").alias("in_j"))
    meets = F.coalesce(F.col("in_i") != F.col("in_j"), F.lit(True))
    meetings = one.join(two, "cluster").where((F.col("i") <= F.col("j")) & meets).select("cluster", "i", "j")
    sides = meetings.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    sets = _sets(dealt.select("node").distinct(), docs, doc_id, text)
    rows = dealt.drop("only").join(sets, "node").join(materialise(sides), ["cluster", "block"])

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        return join_components(group["node"].tolist(), group["component"].tolist(), sets, percent)

    return rows.groupBy("cluster", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def join_components(nodes: list[int], labels: list[int], sets: list[np.ndarray], percent: int) -> pd.DataFrame:
    """Links (a, b) that join the components of `labels` as far as similar pairs do."""
    sizes = np.array([len(s) for s in sets])
    common = np.zeros((len(sets), len(sets)), np.float32)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = 1 << 14
    for begin in range(0, len(values), step):  # a strip of the incidence matrix at a time
        lo, hi = np.searchsorted(column, [begin, begin + step])
        strip = np.zeros((len(sets), min(step, len(values) - begin)), np.float32)
        strip[owner[lo:hi], column[lo:hi] - begin] = 1
        common += strip @ strip.T
    both = np.rint(common).astype(np.int64)
    similar = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    root = {label: label for label in labels}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in np.argwhere(np.triu(similar, 1)).tolist():
        x, y = find(labels[i]), find(labels[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((nodes[i], nodes[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Documents are linked if at least `percent` in a hundred of the union of their shingle sets
    is in both. component_id is the smallest doc_id that links reach. Texts that are null or
    without words have no shingle and are linked with nothing; texts of fewer than five words
    are linked with equal ones only. Rows with one doc_id are one document. A row without
    doc_id is kept, has no component and is linked with nothing. An empty table gives no rows.
    Less than 80 percent is refused: large sets could then share no run.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent is between {LEAST_PERCENT} and 100")
    stored = materialise(sketches(docs, doc_id, text))
    filled = stored.where("n > 0 and doc_id is not null")
    nodes = materialise(filled.groupBy("digest", "n", "sketch").agg(F.min("doc_id").alias("node")))
    entries = keys(nodes, percent)
    heads = entries.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"), F.count(F.lit(1)).alias("c"))
    members = materialise(entries.join(heads.where("c > 1").select("key", "head"), "key"))
    fits = _sizes_fit(F.col("n"), F.col("head.n"), percent) & (F.col("node") != F.col("head.node"))
    star = materialise(members.where(fits).select(F.col("head.node").alias("a"), F.col("node").alias("b")).distinct())
    links = materialise(_verified(materialise(_estimated(star, nodes, percent)), docs, percent, doc_id, text))
    labels = components(links)
    held = _open_lists(members, labels)
    more = materialise(_long_list_links(held, docs, percent, doc_id, text))
    rest = materialise(_estimated(_short_list_pairs(held, percent).join(star, ["a", "b"], "left_anti"), nodes, percent))
    if not rest.isEmpty():
        more = more.unionByName(_verified(rest, docs, percent, doc_id, text))
    labels = components(links.unionByName(more))
    named = nodes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("c"))
    joined = stored.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("c"))).otherwise(F.col("doc_id"))
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that `near_duplicates` keeps, with all their columns."""
    gone = near_duplicates(docs, percent, doc_id, text).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = materialise(gone)
    return docs.join(small(gone), F.col(doc_id).cast("bigint") == F.col("_gone"), "left_anti")
