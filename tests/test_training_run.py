import pytest
from pyspark.sql import functions as F

from postgauge.operators import models
from postgauge.plans import training, training_run
from postgauge.plans.ledger import Ledger, table_digest
from postgauge.session import fresh_path
from postgauge.sources import derived as D
from postgauge.sources import model_files
from postgauge.stages.post_features import PostFeatures


@pytest.fixture(scope="module")
def sides(spark, data):
    return training.split_by_group(D.posts(spark, data))


NUMBERS = {"numericCols": ["AnswerCount"], "categoricalCols": ["PostTypeId"]}
SMALL = {**training.FOREST, "n_estimators": 4, "max_depth": 4, "oob_score": True}


def test_digest_knows_rows_names_and_types_but_no_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    same = table_digest(df)
    assert table_digest(df.orderBy(F.desc("x")).repartition(3).select("y", "x")) == same
    for other in (df.distinct(), df.withColumnRenamed("x", "z"), df.withColumn("x", F.col("x").cast("long")), df.fillna("")):
        assert table_digest(other) != same


def test_stages_run_once_for_an_input(spark):
    folder, ran = fresh_path(spark, "ledger"), []

    def work(path):
        ran.append(path)
        spark.range(3).write.mode("overwrite").parquet(path)

    def lost(path):
        work(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        Ledger(spark, folder).stage("a", "1", lost)
    ledger = Ledger(spark, folder)
    assert [ledger.stage("a", d, work) for d in ("1", "1", "2")] == [f"{folder}/a-1"] * 2 + [f"{folder}/a-2"]
    assert ran == [f"{folder}/a-1", f"{folder}/a-1", f"{folder}/a-2"]
    assert [r["digest"] for r in ledger.rows().orderBy("step").collect()] == ["1", "1", "2"]


def test_a_run_that_is_begun_anew_fits_nothing_again(spark, data, sides, monkeypatch):
    folder, features = fresh_path(spark, "run"), PostFeatures(**NUMBERS)
    with monkeypatch.context() as broken:
        broken.setattr(training_run, "binary_metrics", lambda df: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError, match="lost driver"):
            training_run.run_training(spark, folder, *sides, features, params=SMALL)

    def refuse(*a, **b):
        raise AssertionError("fitted again")

    with monkeypatch.context() as second:
        second.setattr(training_run, "grow", refuse)
        second.setattr(PostFeatures, "_fit", refuse)
        done = training_run.run_training(spark, folder, *sides, features, params=SMALL)
        again = training_run.run_training(spark, folder, *sides, features, params=SMALL)
        with pytest.raises(AssertionError, match="fitted again"):
            training_run.run_training(spark, folder, *sides, features, params=SMALL, seed=7)
    rows = done.ledger.orderBy("step").collect()
    assert [r["stage"] for r in rows] == training_run.STAGES and all(r["seconds"] > 0 for r in rows)
    assert [tuple(r) for r in again.ledger.orderBy("step").collect()] == [tuple(r) for r in rows]

    pairs = [(r["label"], r["prediction"]) for r in done.predictions.collect()]
    assert len(pairs) == training.labeled_training_set(sides[1]).count()
    assert {(r["label"], r["prediction"]): r["n"] for r in done.matrix.collect()} == {(a, p): pairs.count((a, p)) for a in (0, 1) for p in (0, 1)}
    report = {r["name"]: r for r in done.report.collect()}
    accuracy = sum(a == p for a, p in pairs) / len(pairs)
    assert report["accuracy"]["f1_score"] == pytest.approx(accuracy) == pytest.approx(done.metrics.first()["accuracy"])
    assert report["High Quality"]["support"] == sum(a for a, _ in pairs)
    assert 0 <= done.oob_score <= 1 and done.fit_rows == training.labeled_training_set(sides[0]).count()
    loaded = models.predict(model_files.load_model(done.model_path), training.labeled_training_set(sides[1]))
    assert sorted((r["label"], r["prediction"]) for r in loaded.collect()) == sorted(pairs)
    known = model_files.load_model_metadata(spark, done.metadata_path).first()
    assert (known["model_type"], known["label_type"], known["median_threshold"]) == ("random_forest", "quality_based", None)


def test_median_labels(spark, sides):
    done = training_run.run_training(
        spark, fresh_path(spark, "run"), *sides, PostFeatures(**NUMBERS), "logistic_regression", quality_labels=False
    )
    assert done.median_threshold == pytest.approx(sides[0].toPandas()["Score"].median())
    assert done.predictions.count() == sides[1].count() and done.oob_score is None
    known = model_files.load_model_metadata(spark, done.metadata_path).first()
    assert known["label_type"] == "score_based"
