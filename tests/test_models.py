import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.operators import models
from postgauge.plans import ingestion, post_map, training
from postgauge.session import fresh_path
from postgauge.sources import derived as D
from postgauge.sources import model_files, post_files
from postgauge.stages.post_features import PostFeatures, PostFeaturesModel, vector_names


@pytest.fixture(scope="module")
def stage(spark, data):
    D.lexicon(spark, data).select("word", "syl").createOrReplaceTempView("lexicon")
    D.word_vectors(spark, data).createOrReplaceTempView("word_vectors")
    return PostFeatures(textCols=["Title", "Body"], qualityFeatures=True, components=4)


@pytest.fixture(scope="module")
def trained(spark, data, stage):
    train, test = training.split_by_group(D.posts(spark, data))
    forest = {**training.FOREST, "n_estimators": 5, "max_depth": 4}
    return training.train_evaluate(train, test, stage, params=forest)


def test_forest_parameters(spark):
    forest = models.make_classifier("random_forest", 42, params={"n_estimators": 50, "max_depth": 10, "min_samples_split": 5})
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (50, 10, 42)
    assert models.make_classifier(params={"max_depth": None}).getMaxDepth() == 30


def test_forest_from_a_bounded_number_of_rows(spark, data):
    """The bound holds for the fit alone, by a choice that repeats."""
    train, test = training.split_by_group(D.posts(spark, data))
    numbers = PostFeatures(numericCols=["AnswerCount"])
    small = {**training.FOREST, "n_estimators": 2, "max_depth": 2}
    done = [training.train_evaluate(train, test, numbers, params=small, max_fit_rows=n) for n in (None, 20, 20)]
    assert done[0].fit_rows == training.labeled_training_set(train).count()
    assert 0 < done[1].fit_rows == done[2].fit_rows < 40 and done[1].fit_rows < done[0].fit_rows
    assert done[1].predictions.count() == done[0].predictions.count()


def test_logistic_type(spark):
    assert isinstance(models.make_classifier("logistic_regression"), LogisticRegression)


@pytest.mark.parametrize("name", ["unknown_algo", "gradient_boosting"])
def test_unknown_algorithm(name):
    with pytest.raises(ValueError, match="Unknown algorithm"):
        models.make_classifier(name)


def test_metrics_and_timings(trained):
    row = trained.metrics.first()
    assert set(row.asDict()) == {"accuracy", "precision", "recall", "f1_score"}
    assert 0 <= row["accuracy"] <= 1
    assert set(trained.seconds) == {"features", "training", "evaluation"}


def test_holdout_accuracy(spark, data, stage):
    small = {**training.FOREST, "n_estimators": 2, "max_depth": 2}
    assert 0 <= training.holdout_accuracy(D.posts(spark, data), stage, params=small) <= 1


def test_median_labels_use_the_training_threshold(spark, data):
    train, test = training.split_by_group(D.posts(spark, data))
    numbers = PostFeatures(numericCols=["AnswerCount"])
    done = training.train_evaluate(train, test, numbers, "logistic_regression", quality_labels=False)
    assert done.median_threshold == pytest.approx(train.toPandas()["Score"].median())
    assert done.predictions.count() == test.count()


def test_reloaded_model_predicts_the_same(spark, data, trained):
    path = fresh_path(spark, "model")
    model_files.save_model(trained.model, path)
    posts = D.posts(spark, data)
    before = {tuple(r) for r in models.predict(trained.model, posts).select("Id", "prediction").collect()}
    after = {tuple(r) for r in models.predict(model_files.load_model(path), posts).select("Id", "prediction").collect()}
    assert before == after and len(before) == posts.count()


def test_feature_names_and_fit_on_train_only(spark, data, stage):
    train, test = training.split_by_group(D.posts(spark, data))
    _, applied, model = training.fit_train_apply_test(stage, train, test)
    names = vector_names(applied)
    assert names == [f"text_processing__truncatedsvd{i}" for i in range(4)] + [f"quality_processing__{c}" for c in fixed.QUALITY_FEATURES]
    path = fresh_path(spark, "features")
    model.write().overwrite().save(path)
    again = PostFeaturesModel.load(path).transform(test)
    assert {(r["Id"], tuple(r["features"].toArray().round(9))) for r in applied.collect()} == {
        (r["Id"], tuple(r["features"].toArray().round(9))) for r in again.collect()
    }


def test_unseen_category_and_missing_number(spark):
    train = spark.createDataFrame([(i, float(i), c) for i, c in enumerate("aabbccddeeff")], "Id int, n double, c string")
    model = PostFeatures(numericCols=["n"], categoricalCols=["c"]).fit(train)
    row = model.transform(spark.createDataFrame([(1, None, "zz")], "Id int, n double, c string")).first()
    assert list(row["features"].toArray()) == [0.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def test_no_block_configured(spark):
    with pytest.raises(ValueError):
        PostFeatures().fit(spark.range(1)).transform(spark.range(1))


def test_metadata(spark):
    path = fresh_path(spark, "metadata")
    model_files.save_model_metadata(spark, path, "random_forest", None)
    row = model_files.load_model_metadata(spark, path).first()
    assert (row["model_type"], row["label_type"], row["median_threshold"]) == ("random_forest", "quality_based", None)


def test_post_map(spark, data, stage):
    shown = post_map.post_map(D.posts(spark, data), stage)
    rows = shown.collect()
    assert len(rows) == D.posts(spark, data).where("PostTypeId = 1").count()
    assert {r["cluster"] for r in rows} <= {"Answered", "Unanswered"}
    assert all(r["label_store"] == "{}" and r["x"] is not None for r in rows)


XML = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" Title="T" Body="&lt;p&gt;one&#xA;two&lt;/p&gt;&#xA;" Tags="&lt;a&gt;&lt;b&gt;" Score="5" OwnerUserId="7" />
  <row Id="2" PostTypeId="2" ParentId="1" Body="answer &amp;amp; more" Score="x1" OwnerUserId="8"></row>
  <row Id="3" PostTypeId="1" Title="no owner" Body="b" Score="0" />
  <row Id="4" PostTypeId="1" Title="spelled" Body="  c  " Score="-1" OwnerUserId="None" />
  <row Id="5" PostTypeId="1" Body="d" Score="12" OwnerUserId="nan" ClosedDate="2024-01-01T00:00:00.000" />
  <row Id="6" PostTypeId="2" ParentId="3" Body="e" Score="3" OwnerUserId="7" />
</posts>
"""


def test_read_xml(spark, tmp_path):
    (tmp_path / "Posts.xml").write_text(XML)
    rows = {r["Id"]: r for r in post_files.read_posts_xml(spark, str(tmp_path / "Posts.xml")).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    assert rows[1]["Body"] == "<p>one\ntwo</p>\n" and rows[1]["Tags"] == "<a><b>"
    assert rows[2]["Body"] == "answer &amp; more" and rows[2]["Score"] is None
    assert [rows[i]["OwnerUserId"] for i in (1, 3, 4, 5)] == ["7", None, None, None]
    assert rows[4]["Body"] == "  c  "


IRREGULAR = """<?xml version="1.0"?>
<posts>
<row Id="1"
     PostTypeId="1" Body="two
lines &gt; one" LastEditorUserId="77"/><row Id="2" PostTypeId="2" Body='single "quoted" href=x' ContentLicense="L" />
<row PostTypeId="1" Body="no id"></row>
<row/>
</posts>
"""


def test_read_xml_of_any_layout(spark, tmp_path):
    """Rows over two lines, two on a line, without id or attributes; all attributes are found."""
    path = str(tmp_path / "Posts.xml")
    (tmp_path / "Posts.xml").write_text(IRREGULAR)
    df = post_files.read_posts_xml(spark, path, group_column="LastEditorUserId")
    assert [c for c in df.columns if c not in post_files.POST_TYPES] == ["ContentLicense", "LastEditorUserId"]
    got = sorted(((r["Id"] or 0, r["Body"], r["LastEditorUserId"], r["ContentLicense"]) for r in df.collect()), key=str)
    assert got == sorted([
        (0, None, None, None), (0, "no id", None, None),
        (1, "two lines > one", "77", None), (2, 'single "quoted" href=x', None, "L"),
    ], key=str)
    named = post_files.read_posts_xml(spark, path, ["Id", "Nowhere"])
    assert named.columns == ["Id", "Nowhere"] and named.count() == 4


@pytest.mark.parametrize("broken", ['<row Id="1" Body=oops />', '<row Id="1" Body="open', '<row Id="1" Id="2"/>'])
def test_broken_xml_rows_fail(spark, tmp_path, broken):
    (tmp_path / "Posts.xml").write_text(f'<posts>\n<row Id="5" />\n{broken}\n</posts>')
    with pytest.raises(Exception, match="(?i)malformed|xml"):
        post_files.read_posts_xml(spark, str(tmp_path / "Posts.xml"), ["Id", "Body"]).collect()


def test_ingestion(spark, tmp_path):
    (tmp_path / "Posts.xml").write_text(XML)
    done = ingestion.ingest_posts(spark, str(tmp_path / "Posts.xml"), str(tmp_path / "out"))
    assert done.train.count() + done.test.count() == 6
    bodies = {r["Id"]: (r["Body"], r["Tags"]) for r in done.train.unionByName(done.test).collect()}
    assert bodies[1] == ("one\ntwo\n", "a  b")
    assert bodies[2] == ("answer & more", None)
    # Zero, negative and closed are low; 5 without an accepted answer, null and 3 are uncertain.
    assert {r["label"]: r["n"] for r in done.labels.collect()} == {0: 3, -1: 3}
    only = ingestion.ingest_posts(spark, str(tmp_path / "Posts.xml"), str(tmp_path / "out1"), post_type=1)
    assert only.train.count() + only.test.count() == 4


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 1, 'quoted "x", and\nnext line', 5), (2, 1, "", 1), (3, 2, None, None), (4, 1, "  spaces ", 0)]
    df = spark.createDataFrame(rows, "Id long, PostTypeId int, Body string, Score int")
    path = str(tmp_path / "csv")
    post_files.write_posts_csv(df, path)
    back = {r["Id"]: (r["Body"], r["Score"]) for r in post_files.read_posts_csv(spark, path, df.columns).collect()}
    assert back == {1: ('quoted "x", and\nnext line', 5), 2: (None, 1), 3: (None, None), 4: ("  spaces ", 0)}
    assert post_files.read_posts_csv(spark, path, df.columns, questions_only=True).count() == 3


def test_row_local_work_streams(spark, tmp_path):
    """Projections run unchanged on a streaming table."""
    from postgauge.functions.posts import quality_label

    df = spark.createDataFrame([(1, 10, None, None), (2, 0, None, None)], "Id long, Score int, ClosedDate string, AcceptedAnswerId long")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).select("Id", quality_label().alias("label"))
    q = stream.writeStream.format("memory").queryName("streamed_labels").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {tuple(r) for r in spark.table("streamed_labels").collect()} == {(1, 1), (2, 0)}
