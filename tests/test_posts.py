import pytest
from pyspark.sql import functions as F

from postgauge.functions import posts as P
from postgauge.operators import annotate, distribution, evaluation, labeling, matching, models, splitting
from postgauge.sources import post_files

SCORES = [-1, 0, 1, 4, 5, 9, 10, None]


def expected_label(score, accepted, closed):
    if closed is not None:
        return 0
    if score is None:
        return -1
    if score < 0:
        return 0
    if accepted is not None and str(accepted).strip() and score >= 5:
        return 1
    if score >= 10:
        return 1
    return 0 if score == 0 else -1


def test_label_rules_at_every_boundary(spark):
    rows = [(s, a, c) for s in SCORES for a in ("7", " ", None) for c in ("2024-01-01", None)]
    df = spark.createDataFrame(rows, "Score int, AcceptedAnswerId string, ClosedDate string")
    for r in df.withColumn("label", P.quality_label()).collect():
        assert r["label"] == expected_label(r["Score"], r["AcceptedAnswerId"], r["ClosedDate"]), r


def test_missing_optional_columns_read_as_null(spark):
    df = spark.createDataFrame([(10,), (3,), (-2,)], "Score int")
    assert [r["label"] for r in labeling.with_quality_label(df).collect()] == [1, -1, 0]


def test_training_set_drops_uncertain_and_score(spark):
    df = spark.createDataFrame([(1, 10), (2, 3), (3, 0)], "Id int, Score int")
    out = labeling.labeled_training_set(df)
    assert "Score" not in out.columns
    assert {(r["Id"], r["label"]) for r in out.collect()} == {(1, 1), (3, 0)}


def test_median_label_is_strict_and_null_is_false(spark):
    df = spark.createDataFrame([(1, "1"), (2, "2"), (3, "3"), (4, "x")], "Id int, Score string")
    out, median = labeling.median_labeled_set(df)
    assert median == 2.0
    assert {r["Id"]: r["label"] for r in out.collect()} == {1: False, 2: False, 3: True, 4: False}
    assert labeling.median_labeled_set(df, 0.0)[1] == 0.0


POSTS = [
    (1, 1, None, "q1", 3), (2, 1, None, "q2", None), (3, 2, 1, "a1", None), (4, 2, 1, "a2", None),
    (5, 2, None, "lost", None), (6, 2, 99, "dangling", None),
]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(POSTS, "Id long, PostTypeId int, ParentId long, Body string, AcceptedAnswerId long")


def test_matching(posts):
    pairs = matching.match_questions_answers(posts).collect()
    assert {(r["QuestionId"], r["AnswerId"]) for r in pairs} == {(1, 3), (1, 4)}


def test_one_question_with_a_third_of_all_answers(spark):
    """Adaptive execution splits the hot partition; no pair is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ids = F.col("id")
        asked = spark.range(1000).select(ids.alias("Id"), F.lit(1).alias("PostTypeId"), F.lit(None).cast("long").alias("ParentId"), F.lit("q").alias("Body"))
        parent = F.when(ids % 3 == 0, F.lit(7)).otherwise(ids % 1000)
        given = spark.range(1000, 61000, numPartitions=16).select(ids.alias("Id"), F.lit(2).alias("PostTypeId"), parent.alias("ParentId"), F.md5(ids.cast("string")).alias("Body"))
        pairs = matching.match_questions_answers(asked.union(given))
        assert len(pairs.collect()) == 60000
        assert "skew=true" in pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_unanswered_ignores_null_parents(posts):
    assert [r["Id"] for r in matching.unanswered_questions(posts).collect()] == [2]
    assert [r["Id"] for r in matching.answered_questions(posts).collect()] == [1]
    assert tuple(matching.qa_counts(posts).first()) == (1, 1, 1)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([("low", 2.0, 2.0)] * 3, "score_group string, Score double, BodyLength double")
    rows = distribution.length_histogram(df, bins=4).where("rows > 0").collect()
    assert {(r["series"], r["bin"], r["rows"], r["density"]) for r in rows} == {("Score", 2, 3, 4.0), ("BodyLength", 2, 3, 4.0)}


def test_body_limit_is_honoured(spark):
    rows = [(1, 1, "x" * 10, 1), (2, 1, "x" * 30, 5)]
    df = spark.createDataFrame(rows, "Id int, PostTypeId int, Body string, Score int")
    assert distribution.score_split(df, 20).count() == 1


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    assert tuple(evaluation.binary_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0)
    assert {tuple(r) for r in evaluation.confusion_matrix(df).collect()} == {(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 1, 0)}


@pytest.mark.parametrize("exact", [False, True])
def test_split_keeps_authors_together(spark, exact):
    df = spark.range(2000).select(
        F.col("id").alias("Id"), F.when(F.col("id") % 3 == 0, F.lit("one")).when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("OwnerUserId")
    )
    train, test = splitting.split_by_group(df, exact=exact)
    assert train.count() + test.count() == 2000
    assert splitting.group_overlap(train, test).isEmpty()
    groups = train.select("OwnerUserId").distinct().count()
    total = groups + test.select("OwnerUserId").distinct().count()
    if exact:
        assert groups == int(0.7 * total)
    else:
        assert abs(groups / total - 0.7) < 0.05


def test_split_by_unknown_column(spark):
    with pytest.raises(KeyError, match="no column 'nobody'"):
        splitting.split_by_group(spark.range(3), "nobody", "id")


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500).withColumnRenamed("id", "Id")
    first = {r["Id"] for r in splitting.sample_rows(df, 50).collect()}
    assert len(first) == 50
    assert first == {r["Id"] for r in splitting.sample_rows(df.repartition(7), 50).collect()}
    with pytest.raises(ValueError):
        splitting.sample_rows(df, 501)


def test_label_store_round(spark):
    df = spark.createDataFrame(
        [(1, "{}"), (2, '{"Question_quality":"good"}'), (3, "not json"), (4, None), (5, "{broken")], "Id long, label_store string"
    )
    edits = spark.createDataFrame(
        [(1, 1, "Topic", "a"), (1, 2, "Topic", "b"), (2, 1, "Question_quality", "bad"), (5, 1, "Topic", ""), (3, 1, " ", "x")],
        "Id long, ts long, key string, value string",
    ).withColumn("event_id", F.col("ts"))
    out = annotate.expand_labels(annotate.apply_labels(df, edits))
    rows = {r["Id"]: (r["Question_quality"], r["Topic"]) for r in out.collect()}
    assert rows == {1: (None, "b"), 2: ("bad", None), 3: (None, None), 4: (None, None), 5: (None, None)}
    keys = [r["key"] for r in annotate.label_keys(df).collect()]
    assert keys == ["Answer_quality", "Question_quality"]


def test_canonical_keys(spark):
    edits = spark.createDataFrame([("question_QUALITY",), (" topic ",), ("",), ("TOPIC",)], "key string")
    registry = spark.createDataFrame([("Question_quality",)], "key string")
    assert sorted(r["key"] for r in annotate.canonical_keys(edits, registry).collect()) == ["Question_quality", "Topic", "Topic"]


def test_not_a_number_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), None, None, float("nan"))], "Score double, ClosedDate string, AcceptedAnswerId string, AnswerCount double")
    row = df.select(P.quality_label().alias("q"), P.score_above(0).alias("above"), P.answered_flag().alias("a")).first()
    assert tuple(row) == (-1, False, "Unanswered")


def test_whole_numbers_with_a_decimal_point(spark):
    raw = spark.createDataFrame([("7.0", "3", "x"), ("2.5", "-1.0", None)], "Id string, Score string, ParentId string")
    assert [tuple(r) for r in post_files.typed_posts(raw).collect()] == [(7, 3, None), (None, -1, None)]


def test_label_keys_that_clash_are_refused(spark):
    df = spark.createDataFrame([(1, "t", '{"title": "x"}')], f"Id int, Title string, {annotate.STORE} string")
    with pytest.raises(ValueError, match="title"):
        annotate.expand_labels(df)


def test_stores_without_edits_stay_as_they_are(spark):
    stores = ["{broken", '{"a": 1}', '{"b":{"c":2}}']
    df = spark.createDataFrame(list(enumerate(stores)), f"Id int, {annotate.STORE} string")
    edits = spark.createDataFrame([], "Id int, key string, value string, ts int, event_id int")
    assert [r[1] for r in annotate.apply_labels(df, edits).orderBy("Id").select("Id", annotate.STORE).collect()] == stores


def test_forest_depth_beyond_the_limit_is_refused():
    with pytest.raises(ValueError, match="max_depth"):
        models.make_classifier(params={"max_depth": 50})


def test_rows_without_author_and_id_stay_on_one_side(spark):
    """As many rows come out as go in, also those that repeat; alike rows go together."""
    from postgauge.operators import splitting

    rows = [(None, None, f"b{k}") for k in range(40)] + [(None, None, None)] * 3 + [(k, None, "x") for k in range(20)] + [(None, "7", "y")]
    df = spark.createDataFrame(rows, "Id bigint, OwnerUserId string, Body string")
    for exact in (False, True):
        train, test = splitting.split_by_group(df, exact=exact)
        assert train.count() + test.count() == len(rows) and train.count() and test.count()
        assert splitting.group_overlap(train, test).isEmpty()
        assert {t.where("Id is null and Body is null").count() for t in (train, test)} == {0, 3}
