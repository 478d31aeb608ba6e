import math
from collections import Counter

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from postgauge.operators import forest, models
from postgauge.session import fresh_path


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, int((k * 37 % 100 + (k % 7) * 3) > 60), Vectors.dense([k * 37 % 100, k % 7, k % 5])) for k in range(160)]
    return spark.createDataFrame(data, ["Id", "label", "features"])


def test_bags_are_poisson_and_repeat(spark):
    bags = [forest.bag_weight("id", b, 42).alias(f"b{b}") for b in range(2)]
    df = spark.range(40_000).select("id", *bags)
    for b in range(2):
        seen = {r[0]: r["count"] / 40_000 for r in df.groupBy(f"b{b}").count().collect()}
        for k in range(5):
            assert seen[k] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.01)
    assert df.corr("b0", "b1") == pytest.approx(0, abs=0.02)
    again = df.repartition(7).agg(F.sum(F.hash("id", "b0", "b1")))
    assert again.first() == df.agg(F.sum(F.hash("id", "b0", "b1"))).first()


@pytest.mark.parametrize("per_bag", [1, 3])
def test_score_is_that_of_trees_which_never_saw_the_row(spark, rows, per_bag):
    grower = RandomForestClassifier(numTrees=8, maxDepth=6, seed=1)
    done = forest.fit_bagged_forest(rows, grower, "Id", trees_per_bag=per_bag, seed=9)
    ids = [r["Id"] for r in rows.collect()]
    *bags, mean = done.model.stages
    assert len(bags) == -(-8 // per_bag) and sum(b.getNumTrees for b in bags) == 8
    share, trees, every = Counter(), Counter(), Counter()
    for k, bag in enumerate(bags):
        inside = {r[0]: r[1] for r in rows.select("Id", forest.bag_weight("Id", k, 9)).collect()}
        for r in bag.transform(rows).collect():
            votes = r[f"_votes{k}"]
            every[r["Id"]] += votes[1] / 8
            if inside[r["Id"]] == 0:
                share[r["Id"]] += votes[1]
                trees[r["Id"]] += bag.getNumTrees
    label = {r["Id"]: r["label"] for r in rows.collect()}
    judged = [i for i in ids if trees[i]]
    expected = sum((share[i] / trees[i] > 0.5) == (label[i] == 1) for i in judged) / len(judged)
    assert done.oob_score == pytest.approx(expected) and 0.6 < expected <= 1
    got = {r["Id"]: (r["trees"], r["share"]) for r in done.votes.collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: trees[i] for i in ids}
    assert all(got[i][1] == pytest.approx(share[i] / trees[i]) for i in judged)
    predicted = {r["Id"]: r["prediction"] for r in models.predict(done.model, rows).collect()}
    assert predicted == {i: int(every[i] > 0.5 + 1e-12) for i in ids}


def test_a_large_forest_is_grown_and_stored_in_lots(spark, rows, monkeypatch):
    """No more rows times trees at once than the bound, all trees asked for, the same answer again and when reloaded."""
    grown, fit = [], RandomForestClassifier.fit

    def counted(self, data, *args):
        grown.append(self.getNumTrees() * data.count())
        return fit(self, data, *args)

    monkeypatch.setattr(models, "GROWN_ROWS", 480, raising=False)
    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    params = {"n_estimators": 7, "max_depth": 6, "class_weight": "balanced"}
    first, second = (models.fit_classifier(rows, params=params) for _ in range(2))
    assert max(grown) <= 480 and sum(grown) == 2 * 7 * 160

    def answers(model):
        return sorted(tuple(r) for r in models.predict(model, rows).select("Id", "label", "prediction").collect())

    path = fresh_path(spark, "forest")
    PipelineModel([first]).write().overwrite().save(path)
    assert answers(first) == answers(second) == answers(PipelineModel.load(path))
    assert sum(label == p for _, label, p in answers(first)) > 0.9 * 160


def test_weights_nulls_and_saving(spark, rows):
    done = models.fit_forest_with_score(rows, "Id", params={"n_estimators": 4, "max_depth": 3, "class_weight": "balanced", "oob_score": True})
    path = fresh_path(spark, "forest")
    done.model.write().overwrite().save(path)
    again = models.predict(PipelineModel.load(path), rows).select("Id", "prediction").collect()
    assert sorted(again) == sorted(models.predict(done.model, rows).select("Id", "prediction").collect())
    assert set(models.predict(done.model, rows).columns) == {"Id", "label", "features", "prediction"}


def test_a_row_in_every_bag_has_no_answer(spark):
    inside = {r[0] for r in spark.range(40).where(forest.bag_weight("id", 0, 42) > 0).collect()}
    data = [(i, i % 2, Vectors.dense([float(i)])) for i in sorted(inside)]
    df = spark.createDataFrame(data, ["Id", "label", "features"])
    done = forest.fit_bagged_forest(df, RandomForestClassifier(numTrees=1), "Id")
    assert done.oob_score is None and done.votes.where("share is not null or trees > 0").count() == 0


def test_tasks_do_not_multiply_the_nodes(spark, rows, monkeypatch):
    """A bag is grown and asked by as few tasks as its rows need, however many files there are, and by itself."""
    fit, ask, grown, asked = RandomForestClassifier.fit, RandomForestClassificationModel.transform, [], []

    def counted(self, data, *args):
        grown.append((data.rdd.getNumPartitions(), self.getCacheNodeIds()))
        return fit(self, data, *args)

    def seen(self, data, *args):
        asked.append((data.rdd.getNumPartitions(), [c for c in data.columns if c.startswith("_votes")]))
        return ask(self, data, *args)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    monkeypatch.setattr(RandomForestClassificationModel, "transform", seen)
    grower = RandomForestClassifier(numTrees=6, maxDepth=4, seed=1)
    done = forest.fit_bagged_forest(rows.repartition(8), grower, "Id", trees_per_bag=2)
    assert grown == [(1, True)] * 3 and asked == [(1, [])] * 3
    asked.clear()
    got = {r["Id"]: r["prediction"] for r in models.predict(PipelineModel([done.model]), rows.repartition(8)).collect()}
    assert asked == [(1, [])] * 3
    monkeypatch.undo()
    assert got == {r["Id"]: int(r["prediction"]) for r in done.model.transform(rows).collect()}
    monkeypatch.setattr(forest, "TASK_ROWS", 50)  # three or four tasks give the same answers
    assert got == {r["Id"]: r["prediction"] for r in models.predict(done.model, rows.repartition(8)).collect()}
