import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from postgauge.operators import projection, spectral


def layout(spark, edges, **options):
    graph = spark.createDataFrame(edges, "id bigint, neighbor bigint")
    done = spectral.spectral_layout(graph, "id", **options)
    rows = {r["id"]: r for r in done.points.collect()}
    return done, rows


def dense(edges):
    """Eigenvalues of the normalised adjacency, by the textbook."""
    pairs = {(a, b) for a, b in edges if a != b} | {(b, a) for a, b in edges if a != b}
    ids = sorted({a for a, _ in pairs})
    w = np.zeros((len(ids), len(ids)))
    for a, b in pairs:
        w[ids.index(a), ids.index(b)] = 1
    degree = w.sum(1)
    return ids, degree, w / np.sqrt(np.outer(degree, degree))


def ring(n):
    return [(k, (k + s) % n) for k in range(n) for s in (1, 2)]


@pytest.mark.parametrize("n_components", [1, 2, 5])
def test_axes_are_the_leading_eigenvectors(spark, n_components):
    rng = np.random.default_rng(3)
    edges = ring(60) + [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(0, 1)] * 3
    ids, degree, a = dense(edges)
    done, rows = layout(spark, edges, n_components=n_components, tolerance=1e-4)
    expected = np.sort(np.linalg.eigvalsh(a))[::-1][1 : n_components + 1]
    assert np.allclose(done.values, expected, atol=1e-6) and max(done.residuals) <= 1e-4
    assert [rows[i]["degree"] for i in ids] == degree.tolist()
    x = np.array([rows[i]["coordinates"] for i in ids])
    moments = (x * degree[:, None]).T @ x / degree.sum()
    assert np.allclose(moments, np.eye(n_components), atol=1e-8)
    assert np.allclose(degree @ x / degree.sum(), 0, atol=1e-8)
    v = x * np.sqrt(degree / degree.sum())[:, None]
    assert np.linalg.norm(a @ v - v * np.array(done.values), axis=0).max() <= 2e-4


def test_parts_without_an_edge_between_them_lie_apart(spark):
    edges = ring(20) + [(a + 100, b + 100) for a, b in ring(30)]
    done, rows = layout(spark, edges, n_components=1, tolerance=1e-7)
    assert done.values[0] == pytest.approx(1)
    sides = [{round(r["coordinates"][0], 6) for i, r in rows.items() if (i >= 100) == far} for far in (False, True)]
    assert len(sides[0]) == len(sides[1]) == 1 and sides[0] != sides[1]


def test_a_hub_and_small_graphs(spark):
    """A star: one row with an edge to all others; then fewer rows than axes, one row, none."""
    done, rows = layout(spark, [(k, 0) for k in range(1, 300)], n_components=2)
    assert len(rows) == 300 and max(done.residuals) <= spectral.TOLERANCE
    done, rows = layout(spark, [(1, 2), (2, 1)], n_components=3)
    assert done.values == pytest.approx([-1]) and [rows[1]["coordinates"][1:], rows[2]["coordinates"][1:]] == [[0, 0]] * 2
    for nothing in ([(5, 5)], []):
        done, rows = layout(spark, nothing)
        assert (done.values, rows) == ([], {})


def test_projection_places_every_row(spark):
    """Copies, and groups far from each other; the axes tell the groups apart."""
    rng = np.random.default_rng(5)
    rows = [(k, Vectors.dense((rng.normal(size=6) + 50 * (k % 3)).tolist())) for k in range(150)]
    rows += [(1000 + k, rows[0][1]) for k in range(30)]
    df = spark.createDataFrame(rows, ["Id", "features"])
    at = {r["Id"]: r["coordinates"] for r in projection.project(df, n_components=3).collect()}
    assert sorted(at) == sorted(i for i, _ in rows) and all(len(c) == 3 for c in at.values())
    groups = [np.array([at[k] for k in range(150) if k % 3 == g]) for g in range(3)]
    spread = max(np.linalg.norm(g - g.mean(0), axis=1).max() for g in groups)
    apart = min(np.linalg.norm(groups[a].mean(0) - groups[b].mean(0)) for a, b in ((0, 1), (0, 2), (1, 2)))
    assert apart > spread
    one = projection.project_2d(df.limit(1)).first()
    assert (one["x"], one["y"]) == (0, 0)


def test_linear_projection_of_any_width(spark):
    rows = [(k, Vectors.dense([float(k), float(k % 7), float(k % 3)])) for k in range(50)]
    df = spark.createDataFrame(rows, ["Id", "features"])
    at = projection.project(df, n_components=3, method="linear")
    means = at.agg(*[F.avg(F.col("coordinates")[i]) for i in range(3)]).first()
    assert np.allclose(list(means), 0, atol=1e-9)
    with pytest.raises(ValueError, match="Unknown method"):
        projection.project(df, method="other")
