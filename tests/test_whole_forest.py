from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from postgauge.operators import models
from postgauge.operators import whole_forest as W
from postgauge.session import fresh_path


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(3)
    x = np.column_stack([draw.normal(size=1500), draw.integers(0, 4, 1500), draw.normal(1000, 0.01, 1500), draw.normal(size=1500)])
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] == 2)).astype(int)
    data = [(i, int(y[i]), Vectors.dense(x[i])) for i in range(1500)]
    return spark.createDataFrame(data, ["Id", "label", "features"]).repartition(6, "Id")


@pytest.fixture
def whole(monkeypatch):
    monkeypatch.setattr(models, "SPARK_ROWS", 100)
    monkeypatch.setattr(W, "BLOCK_ROWS", 128)

    def refuse(*a, **b):
        raise AssertionError("thresholds of more rows come from a sample")

    monkeypatch.setattr(RandomForestClassifier, "fit", refuse)


def answers(model, rows):
    return sorted(tuple(r) for r in models.predict(model, rows).select("Id", "label", "prediction").collect())


def numbers(rows):
    return rows.select(vector_to_array("features").alias("features"))


def test_thresholds_are_the_values_at_ranks_of_all_rows(spark, rows):
    x = np.array([r[0] for r in numbers(rows).collect()]).astype(np.float32)
    cuts = W.thresholds(numbers(rows), 32)
    ranks = [-(-1500 * j // 32) - 1 for j in range(1, 32)]
    for f in (0, 2, 3):
        assert cuts[f] == sorted(set(np.sort(x[:, f])[ranks].tolist()))
    assert cuts[1] == [0, 1, 2, 3]
    odd = [[float("nan"), -0.0, 1.0], [2.0, 0.0, float("inf")], [-3.0, -1e300, 1.0]] * 5
    df = spark.createDataFrame([(Vectors.dense(v),) for v in odd], ["features"])
    assert W.thresholds(numbers(df), 8) == [[-3, 2], [float("-inf"), 0], [1, float("inf")]]
    assert W.thresholds(numbers(df), 2) == [[2], [float("-inf")], [1]]


def test_values_that_differ_by_task_are_still_counted_together(spark):
    df = spark.range(40).repartition(8).select(F.array(F.col("id").cast("double")).alias("features"))
    assert W.thresholds(df, 4) == [[9, 19, 29]]


def test_a_tree_knows_all_rows(rows, whole):
    """One tree without a bag answers every row it was grown from, as long as bins tell them apart."""
    model = models.fit_classifier(rows, params={"n_estimators": 1})
    got = answers(model, rows)
    assert len(got) == 1500 and sum(label == p for _, label, p in got) > 0.99 * 1500


@pytest.mark.parametrize("unit", [10**6, 200])
def test_a_forest_depends_on_neither_order_nor_partitions(spark, rows, whole, monkeypatch, unit):
    monkeypatch.setattr(W, "UNIT_ROWS", unit)
    monkeypatch.setattr(W, "NODES", 7)
    params = {"n_estimators": 7, "max_depth": 12, "class_weight": "balanced"}
    first = models.fit_classifier(rows, params=params, row_id="Id")
    second = models.fit_classifier(rows.orderBy(F.desc("Id")).coalesce(2), params=params, row_id="Id")
    plan, trees = W.Plan.of(first.plan), spark.read.parquet(first.path).groupBy("tree").count().collect()
    assert first.getNumTrees() == 7 and {r["tree"] for r in trees} == set(range(7))
    assert all(len(t.feature) > 1 for t in plan.tops) == (unit == 200) and len(plan.trees) > (7 if unit == 200 else 3)
    path = fresh_path(spark, "forest")
    PipelineModel([first]).write().overwrite().save(path)
    got = answers(first, rows)
    assert got == answers(second, rows) == answers(PipelineModel.load(path), rows.repartition(3))
    assert sum(label == p for _, label, p in got) > 0.97 * 1500


@pytest.mark.parametrize("unit", [10**6, 200])
@pytest.mark.parametrize("per_bag", [1, 3])
def test_score_is_that_of_trees_which_never_saw_the_row(spark, rows, whole, monkeypatch, unit, per_bag):
    monkeypatch.setattr(W, "UNIT_ROWS", unit)
    params = {"n_estimators": 8, "max_depth": 9, "trees_per_bag": per_bag, "oob_score": True}
    done = models.fit_forest_with_score(rows, "Id", 5, params)
    forest = done.model.stages[0]
    plan = W.Plan.of(forest.plan)
    ids = rows.select("Id", F.xxhash64("Id", F.lit(5)).alias("hash"), vector_to_array("features").alias("x"), "label").orderBy("Id").collect()
    hashes, x = np.array([r["hash"] for r in ids]), np.array([r["x"] for r in ids]).astype(np.float32)
    bins = np.stack([np.searchsorted(np.array(c, np.float32), x[:, i]) for i, c in enumerate(plan.cuts)], axis=1)
    stored = {(r["unit"], r["tree"]): W.Nodes.of(bytes(r["data"])) for r in spark.read.parquet(forest.path).collect()}
    ones, trees, every = np.zeros(1500), Counter(), np.zeros(1500)
    for t, top in enumerate(plan.tops):
        count, end = W.bag_counts(hashes, t // per_bag), top.nodes().ends(bins, np.zeros(1500))
        for i in range(1500):
            unit_, root = top.unit[end[i]], top.root[end[i]]
            share = plan.closed.get(unit_)
            if share is None:
                nodes = stored[unit_, t]
                share = nodes.share[nodes.ends(bins[i : i + 1], np.array([root]))][0]
            every[i] += share
            if count[i] == 0:
                ones[i] += share
                trees[i] += 1
    got = {r["Id"]: (r["trees"], r["share"], r["label"]) for r in done.votes.collect()}
    assert {i: got[i][0] for i in got} == {i: trees[i] for i in range(1500)}
    judged = [i for i in range(1500) if trees[i]]
    assert all(got[i][1] == pytest.approx(ones[i] / trees[i]) for i in judged) and all(got[i][1] is None for i in got if not trees[i])
    right = sum((ones[i] / trees[i] > 0.5) == got[i][2] for i in judged) / len(judged)
    assert done.oob_score == pytest.approx(right) and right > 0.9
    assert [p for *_, p in answers(done.model, rows)] == [int(v > 4 + 1e-9) for v in every]


def test_a_top_that_can_not_be_cut_is_an_end(spark, whole, monkeypatch):
    """Rows that no feature tells apart are answered by their share, however many there are."""
    monkeypatch.setattr(W, "UNIT_ROWS", 50)
    df = spark.range(600).select(F.col("id").alias("Id"), (F.col("id") % 3 == 0).cast("int").alias("label"), F.when(F.col("id") < 300, 1.0).otherwise(2.0).alias("v"))
    df = df.rdd.map(lambda r: (r[0], r[1], Vectors.dense([r[2]]))).toDF(["Id", "label", "features"])
    done = models.fit_forest_with_score(df, "Id", 5, {"n_estimators": 4})
    plan = W.Plan.of(done.model.stages[0].plan)
    assert plan.closed and all(0.15 < s < 0.5 for s in plan.closed.values())
    assert {p for *_, p in answers(done.model, df)} == {0} and done.oob_score == pytest.approx(2 / 3, abs=0.02)


def test_least_rows_of_a_child(rows, whole, spark):
    model = models.fit_classifier(rows, params={"n_estimators": 1, "min_samples_split": 100})
    nodes = W.Nodes.of(bytes(spark.read.parquet(model.path).first()["data"]))
    x = np.array([r[0] for r in numbers(rows).collect()]).astype(np.float32)
    bins = np.stack([np.searchsorted(np.array(c, np.float32), x[:, i]) for i, c in enumerate(W.Plan.of(model.plan).cuts)], axis=1)
    assert 2 < len(nodes.feature) and min(Counter(nodes.ends(bins, np.zeros(1500)).tolist()).values()) >= 50


def test_other_labels_and_lengths_are_refused(spark, rows, whole):
    with pytest.raises(Exception, match="labels are 0 or 1"):
        models.fit_classifier(rows.withColumn("label", F.col("label") + 1))
