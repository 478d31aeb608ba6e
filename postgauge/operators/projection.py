"""A few coordinates per row from its feature vector."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.operators.neighbors import knn_graph
from postgauge.operators.spectral import TOLERANCE, spectral_layout
from postgauge.session import materialise


def linear_layout(df: DataFrame, features: str = "features", row_id: str = "Id", n_components: int = 2) -> DataFrame:
    """The main directions as `coordinates`, centred, with the largest loading positive."""
    data = df.select(row_id, features)
    model = PCA(k=n_components, inputCol=features, outputCol="_at").fit(data)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(n_components)]
    at = model.transform(data).select(row_id, vector_to_array("_at").alias("_at"))
    at = at.select(row_id, *[(F.col("_at")[i] * signs[i]).alias(f"_{i}") for i in range(n_components)])
    centre = at.agg(*[F.avg(f"_{i}").alias(f"_{i}") for i in range(n_components)]).first()
    return at.select(row_id, F.array(*[F.col(f"_{i}") - F.lit(centre[i]) for i in range(n_components)]).alias("coordinates"))


def neighbor_layout(
    df: DataFrame,
    features: str = "features",
    row_id: str = "Id",
    n_components: int = 2,
    k: int = fixed.NEIGHBORS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """`coordinates` from the graph of `k` nearest neighbours; a row without any lies at the origin."""
    data = materialise(df.select(F.col(row_id).alias("_id"), vector_to_array(features).alias("_at")))
    graph = knn_graph(data, "_id", "_at", k)
    points = spectral_layout(graph, "_id", n_components=n_components, tolerance=tolerance).points
    origin = F.array_repeat(F.lit(0.0), n_components)
    at = data.select("_id").join(points, "_id", "left")
    return at.select(F.col("_id").alias(row_id), F.coalesce("coordinates", origin).alias("coordinates"))


METHODS = {"neighbors": neighbor_layout, "linear": linear_layout}


def project(df: DataFrame, features: str = "features", row_id: str = "Id", n_components: int = 2, method: str = "neighbors") -> DataFrame:
    """`row_id, coordinates`: by the neighbour graph, or along the directions of largest variance."""
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}; choose {' or '.join(METHODS)}")
    return METHODS[method](df, features, row_id, n_components)


def project_2d(df: DataFrame, features: str = "features", row_id: str = "Id", method: str = "neighbors") -> DataFrame:
    """Two coordinates as `x` and `y`."""
    at = project(df, features, row_id, 2, method)
    return at.select(row_id, F.get("coordinates", F.lit(0)).alias("x"), F.get("coordinates", F.lit(1)).alias("y"))
