"""The ways taken when a side is large or a key is hot give the same results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postgauge.operators import lookup, neighbors, quantiles, splitting, structured, textstats, vectors
from postgauge.sources import derived as D


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_by_weight_equals_broadcast(spark, how):
    tokens = spark.range(3000).select(
        F.col("id") % 50, F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 > 0, F.concat(F.lit("w"), F.col("id") % 40)).alias("word")
    ).toDF("doc", "word")
    table = spark.createDataFrame([("hot", 1)] + [(f"w{i}", i) for i in range(30)], "word string, syl int")

    def total(max_rows):
        found = lookup.lookup_words(tokens, table, how, max_rows)
        return rows(found.groupBy("doc", "word", "syl").agg(F.sum("uses").alias("n")))

    assert total(100) == total(3)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_heavy_words_stay_where_they_are(spark, how):
    """A third of all tokens is a word the table has, a third one it lacks, and some are null."""
    word = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "unknown").when(F.col("id") % 5 > 0, F.concat(F.lit("w"), F.col("id") % 40))
    tokens = spark.range(6000).select((F.col("id") % 50).alias("doc"), word.alias("word"))
    table = spark.createDataFrame([("hot", 1)] + [(f"w{i}", i) for i in range(30)], "word string, syl int")
    assert rows(lookup.heavy_words(tokens, 10)) == [("hot",), ("unknown",)]

    def total(*sizes):
        found = lookup.lookup_words(tokens, table, how, *sizes)
        return rows(found.groupBy("doc", "word", "syl").agg(F.sum("uses").alias("n")))

    assert total(100) == total(3, 10) == total(3, 1) == total(3, 10_000)
    assert lookup.lookup_words(tokens.limit(0), table, how, 3).collect() == []
    assert lookup.lookup_words(tokens, table, how, 3, 10).where("uses > 1").where(F.col("word").isin("hot", "unknown")).isEmpty()


def test_vectors_and_report_without_broadcast(spark, data, monkeypatch):
    docs, lexicon, table = D.documents(spark, data), D.lexicon(spark, data), D.word_vectors(spark, data)
    text = F.col("text")

    def both():
        means = vectors.mean_word_vector(docs, text, "doc_id", table, 64)
        report = textstats.text_report(docs, "text", "doc_id", lexicon)
        values = means.orderBy("doc_id").collect()
        return np.array([r["vector"] for r in values]), rows(report)

    small = both()
    monkeypatch.setattr(lookup, "fits", lambda *a: False)
    large = both()
    assert np.allclose(small[0], large[0])
    assert small[1] == large[1]


@pytest.mark.parametrize("seed", range(3))
def test_wide_quantiles_are_exact(spark, seed):
    rng = np.random.default_rng(seed)
    values = rng.lognormal(size=20_000)
    values[rng.random(20_000) < 0.35] = 1.0  # one value holds a third of the rows
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(6)
    probabilities = [0.0, 0.25, 0.3301, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(df, {"x": F.col("x")}, probabilities, max_distinct=100)["x"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)
    assert quantiles.exact_quantiles(df, {"x": F.col("x")}, probabilities)["x"] == pytest.approx(got, rel=1e-12)


def test_quantiles_of_several_columns_and_extreme_values(spark):
    big = [-1e308, -5.0, 0.0, 1e-300, 2e-300, 7.0, 1e308] * 3
    df = spark.createDataFrame([(x, float(k % 2), None) for k, x in enumerate(big)], "a double, b double, c double")
    columns = {c: F.col(c) for c in "abc"}
    for most in (2, 1000):
        got = quantiles.exact_quantiles(df, columns, [0.0, 0.5, 1.0], most)
        assert got == {"a": [-1e308, 1e-300, 1e308], "b": [0.0, 0.0, 1.0], "c": [None] * 3}


def test_infinite_values_keep_their_ranks(spark):
    values = [float("-inf")] * 2 + [1.0, 2.0] + [float("inf")] * 3
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = quantiles.exact_quantiles(df, {"x": F.col("x")}, [0.0, 0.5, 1.0], 2)["x"]
    assert got == [float("-inf"), 2.0, float("inf")]


def test_first_rows_with_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "n"), (1, "a"), (1, "b"), (2, "c")], "Id long, x string")
    assert [r["Id"] for r in splitting.first_rows(df, 2, "Id", F.col("Id")).collect()] == [None, 1]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles.exact_median(df, F.col("x")) is None
    with pytest.raises(ValueError):
        structured.fit_medians(df, ["x"])


def brute(points, k, metric="euclidean"):
    ids = np.arange(len(points))
    if metric == "cosine":
        norm = np.linalg.norm(points, axis=1)
        unit = points / np.where(norm == 0, 1, norm)[:, None]
        d = 1 - unit @ unit.T
        zero = norm == 0
        d[np.ix_(zero, zero)] = 0.0
        d = np.where(zero[:, None] ^ zero[None, :], 1.0, d)
    else:
        d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    d = np.round(d, 9)
    out = set()
    for i in ids:
        order = [j for j in np.lexsort((ids, d[i])) if j != i][:k]
        out |= {(int(i), int(j), r + 1, float(d[i, j])) for r, j in enumerate(order)}
    return out


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("copies", [0, 130])
def test_neighbors_equal_brute_force(spark, metric, copies):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 5)) * 8
    points = centres[rng.integers(0, 6, 400)] + rng.normal(size=(400, 5))
    points[:copies] = points[0]  # a third of the rows are one vector
    if copies:
        points[300:303] = points[300]
        points[-2:] = 0.0
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").repartition(5)
    found = neighbors.knn_graph(df, "id", "v", k=7, metric=metric, block_rows=16)
    got = {(r["id"], r["rank"]): (r["neighbor"], r["distance"]) for r in found.collect()}
    expected = {(i, r): (j, d) for i, j, r, d in brute(points, 7, metric)}
    assert {key: n for key, (n, _) in got.items()} == {key: n for key, (n, _) in expected.items()}
    assert all(abs(got[key][1] - d) < 1e-7 for key, (_, d) in expected.items())


def test_neighbors_far_from_the_origin(spark):
    """Small differences between large numbers decide, and pivots route by them."""
    rng = np.random.default_rng(3)
    points = 1e4 + 1e-5 * np.round(rng.normal(size=(60, 8)) * 100)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    found = neighbors.knn_graph(df, "id", "v", k=5, block_rows=16)
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    expected = {(i, r + 1): j for i in range(60) for r, j in enumerate([j for j in np.lexsort((range(60), d[i])) if j != i][:5])}
    assert {(r["id"], r["rank"]): r["neighbor"] for r in found.collect()} == expected


def test_fewer_rows_than_neighbors(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], "id long, v array<double>")
    assert neighbors.knn_graph(df, "id", "v", k=15).count() == 12


def test_cells_are_skipped(spark):
    """Far clusters are not visited, whatever the number of rows in them."""
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(200, 3)) + 1000 * c for c in range(4)])
    pivots = points[::50]
    home = neighbors._distances(points, pivots).argmin(1)
    d = neighbors._distances(points, pivots)[np.arange(len(points)), home]
    m = len(pivots)
    radius = np.array([d[home == c].max() for c in range(m)])
    inner = np.array([d[home == c].min() for c in range(m)])
    near = np.full((m, 6), np.inf)
    for c in range(m):
        first = np.sort(d[home == c])[:6]
        near[c, : len(first)] = first
    import pandas as pd

    batch = pd.DataFrame({"rep": range(len(points)), "vector": list(points), "leaf": home.astype(str), "reach": np.inf})
    cells, names = neighbors._Cells(pivots, radius, inner, near, 5, None), np.array([str(c) for c in range(m)], dtype=object)
    visits = pd.concat(neighbors._route(cells, names)([batch]))
    assert len(visits) <= len(points) * m / 4
    assert len(pd.concat(neighbors._route(cells, names)([batch.assign(reach=0.0)]))) == 0


def clusters(rng, n):
    """Groups of very different size, one with half of the rows."""
    centres = rng.normal(size=(9, 4)) * 20
    which = np.where(rng.random(n) < 0.5, 0, rng.integers(0, 9, n))
    return centres[which] + rng.normal(size=(n, 4))


@pytest.mark.parametrize("fan,routed", [(3, 16), (6, 10_000)])
def test_a_deep_tree_finds_the_same_neighbors(spark, monkeypatch, fan, routed):
    monkeypatch.setattr(neighbors, "ROUTED", routed)
    points = clusters(np.random.default_rng(8), 300)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").repartition(4)
    found = neighbors.knn_graph(df, "id", "v", k=6, block_rows=8, fan=fan)
    got = {(r["id"], r["rank"]): r["neighbor"] for r in found.collect()}
    assert got == {(i, r): j for i, j, r, _ in brute(points, 6, "euclidean")}


def test_leaves_keep_their_size_as_rows_grow(spark):
    rng = np.random.default_rng(2)
    seen = []
    for n in (300, 1500):
        rows = [(i, p.tolist()) for i, p in enumerate(clusters(rng, n))]
        groups = spark.createDataFrame(rows, "rep long, vector array<double>")
        placed, pivots, top, levels = neighbors._tree(groups, 5, 16, 4)
        leaves = [r["count"] for r in placed.groupBy("cell").count().collect()]
        assert sum(leaves) == n and max(leaves) <= neighbors.SPLIT * 16
        assert len(pivots) == len(top) == 4
        # No table that reaches the driver or a task whole is longer than the fan.
        assert all(level.groupBy("parent").count().agg(F.max("count")).first()[0] <= 4 for level in levels)
        seen.append(len(levels))
    assert seen[1] > seen[0] > 0


def test_probes_trade_neighbors_for_visits(spark):
    """The approximate graph: recall grows with the probes, and reaches 0.9 with few."""
    points = np.random.default_rng(4).normal(size=(1500, 8))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    truth = {(i, j) for i, j, _, _ in brute(points, 10, "euclidean")}
    recall = []
    for probes in (0, 12):
        found = neighbors.knn_graph(df, "id", "v", k=10, block_rows=64, probes=probes).collect()
        recall.append(len(truth & {(r["id"], r["neighbor"]) for r in found}) / len(truth))
    assert recall[0] < 0.7 and recall[1] >= 0.9, recall


def test_rows_are_not_stored_once_for_each_leaf_they_visit(spark, monkeypatch):
    """In many dimensions nothing can be left out; rows meet all others by teams, and no table takes them leaf by leaf."""
    points, stored = np.random.default_rng(6).normal(size=(600, 24)), []
    keep = neighbors.materialise

    def counted(df):
        out = keep(df)
        stored.append(out.count())
        return out

    monkeypatch.setattr(neighbors, "materialise", counted)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").repartition(4)
    found = neighbors.knn_graph(df, "id", "v", k=5, block_rows=8)
    got = {(r["id"], r["rank"]): r["neighbor"] for r in found.collect()}
    assert got == {(i, r): j for i, j, r, _ in brute(points, 5, "euclidean")}
    assert max(stored) <= 10 * len(points), stored


def test_teams_are_bounded_and_small_distances_between_far_groups_decide(spark, monkeypatch):
    """Single precision can't tell these rows apart, and one first-level cell is larger than a team."""
    rng = np.random.default_rng(7)
    points = 100 * rng.normal(size=(5, 6))[rng.integers(0, 5, 400)] + 1e-3 * rng.normal(size=(400, 6))
    sizes, plain = [], neighbors._teams

    def counted(*args):
        dealt, centres, most = plain(*args)
        sizes.extend((r["count"], most) for r in dealt.groupBy("team").count().collect())
        return dealt, centres, most

    monkeypatch.setattr(neighbors, "_teams", counted)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").repartition(4)
    found = neighbors.knn_graph(df, "id", "v", k=6, block_rows=8, fan=3)
    got = {(r["id"], r["rank"]): r["neighbor"] for r in found.collect()}
    assert got == {(i, r): j for i, j, r, _ in brute(points, 6, "euclidean")}
    assert len(sizes) >= neighbors.TEAMS and all(n <= 2 * most for n, most in sizes), sizes


def test_top_categories_break_ties_by_later_name(spark):
    df = spark.createDataFrame([(c,) for c in "aabbccddeeffg"] + [(None,)], "c string")
    assert structured.fit_categories(df, "c", 5) == (["c", "d", "e", "f"], True)
    few = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert structured.fit_categories(few, "c", 5) == (["a", "b", "missing"], False)
    kept = structured.one_hot("c", ["a", "b"], True)
    unseen = spark.createDataFrame([("z",)], "c string").select(*kept.values()).first()
    assert tuple(unseen) == (0.0, 0.0, 1.0)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    mean, deviation = structured.fit_scales(df, {"x": F.col("x")})["x"]
    assert [r[0] for r in df.select(structured.scale(F.col("x"), mean, deviation)).collect()] == [0.0, 0.0]


def test_svd_components_are_orthogonal_and_stable(spark, data):
    means = D.table(spark, data, "embeddings").select(F.col("embedding").cast("array<double>").alias("v"))
    x = np.array([r["v"] for r in means.collect()])
    basis = vectors.fit_svd(means.repartition(8), "v", 10)
    assert np.allclose(basis.T @ basis, np.eye(10))
    assert np.allclose(basis, vectors.fit_svd(means.coalesce(1), "v", 10), atol=1e-8)
    singular = np.linalg.svd(x, compute_uv=False)[:10]
    assert np.allclose(np.linalg.norm(x @ basis, axis=0), singular)


def test_pairs_that_may_be_near_are_found_flat(monkeypatch):
    """Every pair within the limit, in rows' order, without a two-dimensional search of all pairs for few hits."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(60, 8)), rng.normal(size=(90, 8))
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    limit = np.sort(d, 1)[:, 5]
    nonzero = np.nonzero

    def flat(x):
        assert np.ndim(x) == 1
        return nonzero(x)

    monkeypatch.setattr(np, "nonzero", flat)
    rows, cols = neighbors._candidates(a, b, limit, 6)
    monkeypatch.undo()
    assert (np.diff(rows) >= 0).all() and set(zip(*map(list, nonzero(d <= limit[:, None])))) <= set(zip(rows, cols))
    assert len(rows) < 60 * 12
