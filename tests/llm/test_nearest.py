import math
import random

import numpy as np

from pyspark.sql import functions as F

from postgauge.llm import nearest as A
from postgauge.llm.queries import QUERIES


def expected(rows, queries, k=5):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    norms = np.linalg.norm(vectors, axis=1)
    out = {}
    for q in np.flatnonzero([i in queries for i in ids]):
        scores = vectors @ vectors[q] / (norms * norms[q])
        order = [j for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def recall(got, want):
    found = {(r.query_id, r.vec_id) for r in got}
    hits = sum((q, i) in found for q, near in want.items() for i, _ in near)
    return hits / max(1, sum(map(len, want.values())))


def test_query_recall_and_scores(spark, rows):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op4_nearest_vectors"](spark, folder).collect()
    held = [(r["vec_id"], r["embedding"]) for r in rows("embeddings", folder)]
    want = expected(held, {i for i, _ in held if i % 50 == 0})
    assert recall(got, want) >= 0.9
    vectors = {i: np.array(v, float) for i, v in held}
    for r in got:
        a, b = vectors[r.query_id], vectors[r.vec_id]
        assert math.isclose(r.score, a @ b / math.sqrt((a @ a) * (b @ b)), abs_tol=1e-12)
    assert sorted(r.rank for r in got) == sorted(list(range(1, 6)) * len(want))


def test_many_cells_ties_and_bad_vectors(spark):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 3) for _ in range(16)] for _ in range(12)]
    held = [(k, [c + rng.gauss(0, 0.6) for c in rng.choice(centres)]) for k in range(1500)]
    copies = [(2000 + k, held[0][1]) for k in range(300)]  # one vector three hundred times
    bad = [(5000, None), (5050, []), (5100, [0.0] * 16), (5150, [None] + [1.0] * 15), (5200, [math.nan] * 16)]
    bad += [(None, [1.0] * 16), (5300, [math.inf] * 16), (5350, [1.0, 2.0])]
    table = spark.createDataFrame(held + copies + bad, "vec_id bigint, embedding array<double>").withColumn("cell", F.lit(1))
    search = A.Search(cell_rows=100, leaf_rows=16, queries_at_once=7)
    got = A.nearest(table, F.col("vec_id") % 50 == 0, search).collect()
    want = expected(held + copies, {i for i, _ in held + copies if i % 50 == 0})
    assert {r.query_id for r in got} == set(want)  # 5350 has no other vector of its width
    assert recall(got, want) >= 0.9
    first = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0]
    assert first == [2000, 2001, 2002, 2003, 2004]
    again = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 2050]
    assert again == [0, 2000, 2001, 2002, 2003]
    assert A.nearest(table.limit(0), F.col("vec_id") % 50 == 0, search).collect() == []


def test_equal_vectors_tie_exactly():
    """Ids decide among copies, wherever they lie in their leaf."""
    import pandas as pd

    rng = np.random.default_rng(6)
    for trial in range(60):
        points = rng.normal(size=(127, 64))
        places = rng.choice(127, 6, replace=False)
        points[places] = points[places[0]]
        query = points[places[0]] + rng.normal(size=64) * 0.01
        search = A.Search(leaf_rows=int(rng.integers(8, 200)))
        matrix = A.projection(64, search)

        def frame(ids, rows):
            units = rows / np.linalg.norm(rows, axis=1)[:, None]
            return pd.DataFrame({"vec_id": ids, "embedding": list(rows), "place": list(units @ matrix)})

        got = A.search_cell(frame(np.arange(127), points), frame([1000], query[None]).assign(bound=math.inf), search)
        assert got["vec_id"].tolist() == sorted(places.tolist())[:5] and got["score"].nunique() == 1


def test_vectors_of_any_finite_size_take_part(spark):
    rng = np.random.default_rng(7)
    held = [(k, (rng.normal(size=8) * 10.0 ** (k % 9 * 70 - 280)).tolist()) for k in range(200)]
    table = spark.createDataFrame(held, "vec_id bigint, embedding array<double>")
    got = A.nearest(table, F.col("vec_id") % 50 == 0, A.Search(cell_rows=50)).collect()
    units = [(i, (np.array(v) / np.abs(v).max()).tolist()) for i, v in held]
    want = expected(units, {0, 50, 100, 150})
    assert recall(got, want) >= 0.9
    best = {(q, i): s for q, near in want.items() for i, s in near}
    assert all(math.isclose(r.score, best[r.query_id, r.vec_id], abs_tol=1e-12) for r in got if (r.query_id, r.vec_id) in best)


def test_chi_square_quantiles():
    for p, m, x in ((0.95, 8, 15.507313), (0.5, 2, 1.386294), (0.99, 10, 23.209251)):
        assert math.isclose(A.chi_square_quantile(p, m), x, rel_tol=1e-6)
