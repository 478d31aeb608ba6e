"""Mean word vectors as one product: against plain sums, wide, and without moving a row."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postgauge.operators import vectors

TEXTS = [
    (1, "red fish, blue fish"), (2, None), (3, ""), (4, "unknown words only"), (5, "Red red blue . ."),
    (6, "red " * 5000 + "fish"), (None, "blue"), (8, "none red"), (9, "halfway"),
]


def table(spark, dims):
    rng = np.random.default_rng(7)
    words = {w: rng.normal(size=dims).tolist() for w in ("red", "fish", "blue", ",", "idle")}
    words["halfway"] = [None] + [1.0] * (dims - 1)
    rows = [*words.items(), ("none", None), (None, [1.0] * dims)]
    return words, spark.createDataFrame(rows, "word string, vector array<double>")


def plain(text, words, dims):
    counts = Counter(w for w in re.findall(r"\w+|[^\w\s]", text or "") if w in words)
    total = sum((n * np.array([x or 0.0 for x in words[w]]) for w, n in counts.items()), np.zeros(dims))
    return total / max(1, counts.total())


@pytest.mark.parametrize("dims, gathered", [(3, 1 << 20), (3, 4), (300, 1 << 20), (300, 700)])
def test_means_are_plain_sums(spark, monkeypatch, dims, gathered):
    monkeypatch.setattr(vectors, "GATHERED", gathered)
    words, known = table(spark, dims)
    docs = spark.createDataFrame(TEXTS, "id bigint, body string").withColumn("vector", F.lit("clash")).repartition(2)
    means = vectors.mean_word_vector(docs, F.col("body"), "id", known)
    got = {r["id"]: r["vector"] for r in means.collect()}
    assert means.columns == ["id", "vector"] and len(got) == len(TEXTS)
    for k, text in TEXTS:
        assert np.allclose(got[k], plain(text, words, dims)), text
    assert vectors.mean_word_vector(docs.limit(0), F.col("body"), "id", known).collect() == []


def test_blocks_of_a_product_change_nothing():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    matrix, rows = rng.normal(size=(40, 5)), {f"w{k}": k for k in range(40)}
    lists = [[f"w{k}" for k in rng.integers(0, 60, size=n)] for n in rng.integers(0, 90, size=50)] + [None, []]
    tokens = pa.array(lists, pa.list_(pa.string()))
    whole = vectors.batch_means(tokens, rows, matrix)
    for gathered in (1, 5, 35, 1000):
        old, vectors.GATHERED = vectors.GATHERED, gathered
        try:
            assert np.allclose(vectors.batch_means(tokens, rows, matrix), whole)
        finally:
            vectors.GATHERED = old
    assert np.allclose(vectors.batch_means(tokens.slice(7, 9), rows, matrix), whole[7:16])
    assert not vectors.batch_means(tokens, {}, np.zeros((0, 5))).any()


def test_nothing_moves(spark, capsys):
    _, known = table(spark, 300)
    docs = spark.createDataFrame(TEXTS, "id bigint, body string")
    vectors.mean_word_vector(docs, F.col("body"), "id", known, 300).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "Exchange" not in plan and "Generate" not in plan


def test_tables_beyond_the_matrix_are_joined(spark, monkeypatch):
    words, known = table(spark, 3)
    docs = spark.createDataFrame([t for t in TEXTS if t[0] != 9], "id bigint, body string")
    monkeypatch.setattr(vectors, "MATRIX_NUMBERS", 6)
    got = {r["id"]: r["vector"] for r in vectors.mean_word_vector(docs, F.col("body"), "id", known).collect()}
    for k, text in TEXTS:
        assert k == 9 or np.allclose(got[k], plain(text, words, 3)), text
