"""Named queries over the driver tables; `oracle.py` states most of them in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.functions import fixed
from postgauge.functions import posts as P
from postgauge.functions import text as X
from postgauge.operators import annotate, distribution, evaluation, labeling, matching, models
from postgauge.operators import neighbors, projection, quality, sentences, spectral, splitting, structured, textstats, vectors
from postgauge.operators.label_table import LabelTable
from postgauge.plans import post_map as maps
from postgauge.plans import training, training_run
from postgauge.sources import derived as D
from postgauge.session import fresh_path, materialise, spread
from postgauge.sources import model_files, post_files
from postgauge.stages.post_features import PostFeatures, vector_names

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_WIDE = {T.ByteType, T.ShortType, T.IntegerType, T.BooleanType}


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and doubles at six places, so engines can be compared."""

    def column(f: T.StructField):
        if type(f.dataType) in _WIDE:
            return F.col(f"`{f.name}`").cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(F.col(f"`{f.name}`").cast("double"), 6).alias(f.name)
        return F.col(f"`{f.name}`")

    return df.select(*[column(f) for f in df.schema.fields])


def query(f: Query) -> Query:
    QUERIES[f.__name__] = lambda spark, folder: plain(f(spark, folder))
    return f


def long_form(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    return df.select(row_id, F.posexplode(vector).alias("dim", "value"))


# --- reading --------------------------------------------------------------

@query
def read_posts_limited(spark, folder):
    return post_files.limit_posts(D.posts(spark, folder)).select("Id", "PostTypeId", "Score")


@query
def read_posts_xml(spark, folder):
    """Posts written as XML rows and read back."""
    posts, path = D.posts(spark, folder), fresh_path(spark, "posts_xml")
    post_files.write_posts_xml(posts, path)
    return post_files.read_posts_xml(spark, path, posts.columns)


@query
def read_posts_csv(spark, folder):
    """Posts written as CSV and read back, questions only."""
    posts, path = D.posts(spark, folder), fresh_path(spark, "posts_csv")
    post_files.write_posts_csv(posts, path)
    return post_files.read_posts_csv(spark, path, posts.columns, questions_only=True)


@query
def write_posts_csv(spark, folder):
    """Both sides of a split written as CSV and read back together."""
    path = fresh_path(spark, "split_csv")
    train, test = splitting.split_by_group(D.posts(spark, folder))
    post_files.write_posts_csv(train, f"{path}/train")
    post_files.write_posts_csv(test, f"{path}/test")
    sides = [post_files.read_posts_csv(spark, f"{path}/{s}", train.columns).withColumn("side", F.lit(s)) for s in ("train", "test")]
    return sides[0].unionByName(sides[1])


# --- projections and filters ----------------------------------------------

@query
def normalize_group_key(spark, folder):
    raw = F.when(F.col("OwnerUserId").isNull(), "None").when(F.col("Id") % 7 == 0, "nan").otherwise(F.col("OwnerUserId"))
    return D.posts(spark, folder).select("Id", raw.alias("OwnerUserId")).select("Id", P.group_key("OwnerUserId").alias("OwnerUserId"))


@query
def strip_html(spark, folder):
    pages = spread(D.table(spark, folder, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", X.strip_html("html").alias("text"))


@query
def filter_questions(spark, folder):
    return matching.questions(D.posts(spark, folder)).select("Id", "Title", "Score")


@query
def clean_tags(spark, folder):
    tags = F.concat(F.lit("<"), "p_type", F.lit("><"), "p_brand", F.lit(">|["), "p_name", F.lit("]\t"))
    return D.table(spark, folder, "part").select("p_partkey", tags.alias("Tags")).select("p_partkey", X.clean_tags("Tags").alias("Tags"))


def _raw_scores(spark, folder):
    raw = F.when(F.col("Id") % 7 == 0, "n/a").when(F.col("Id") % 11 == 0, "").otherwise(F.col("Score").cast("string"))
    return D.posts(spark, folder).select("Id", raw.alias("Score"))


@query
def coerce_numeric(spark, folder):
    return _raw_scores(spark, folder).select("Id", P.numeric("Score").alias("Score"))


@query
def quality_label(spark, folder):
    return labeling.with_quality_label(D.posts(spark, folder)).select("Id", "label")


@query
def labeled_training_set(spark, folder):
    return labeling.labeled_training_set(D.posts(spark, folder))


@query
def median_label(spark, folder):
    labeled, _ = labeling.median_labeled_set(D.posts(spark, folder))
    return labeled.select("Id", "label")


@query
def answered_flag(spark, folder):
    return D.posts(spark, folder).select("Id", P.answered_flag().alias("cluster"))


@query
def fill_display_text(spark, folder):
    shown = ["Title", "OwnerUserId", "Score", "AnswerCount"]
    return D.posts(spark, folder).select("Id", *[P.display_text(c).alias(c) for c in shown])


@query
def concat_text(spark, folder):
    return D.posts(spark, folder).select("Id", X.concat_text("Title", "Body").alias("text"))


@query
def select_features(spark, folder):
    return D.posts(spark, folder).select("Title", "Body")


# --- joins ----------------------------------------------------------------

@query
def match_questions_answers(spark, folder):
    return matching.match_questions_answers(D.posts(spark, folder))


@query
def unanswered_questions(spark, folder):
    return matching.unanswered_questions(D.posts(spark, folder)).select("Id", "Score")


@query
def answered_questions(spark, folder):
    return matching.answered_questions(D.posts(spark, folder)).select("Id", "Score")


@query
def lexicon_lookup(spark, folder):
    found = textstats.with_syllables(
        textstats.tokens(D.documents(spark, folder), "text", "doc_id"), D.lexicon(spark, folder)
    )
    return found.where(F.col("token").isNotNull()).groupBy("token").agg(
        F.max("syllables").alias("syllables"), F.sum("uses").alias("uses")
    )


@query
def word_vector_lookup(spark, folder):
    found = vectors.word_vector_lookup(
        D.documents(spark, folder),
        X.text("text"),
        "doc_id",
        D.word_vectors(spark, folder),
        D.vector_width(spark, folder),
    )
    return found.groupBy("word").agg(
        F.sum("uses").alias("uses"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v)).alias("vector_sum")
    )


# --- aggregates -----------------------------------------------------------

@query
def qa_counts(spark, folder):
    return matching.qa_counts(D.posts(spark, folder))


@query
def label_distribution(spark, folder):
    return labeling.label_distribution(labeling.with_quality_label(D.posts(spark, folder)))


@query
def label_summary(spark, folder):
    return labeling.label_summary(labeling.with_quality_label(D.posts(spark, folder)))


@query
def score_median(spark, folder):
    return spark.range(1).select(F.lit(labeling.score_median(D.posts(spark, folder))).alias("median"))


@query
def score_split(spark, folder):
    return distribution.score_split(D.posts(spark, folder))


@query
def iqr_filter(spark, folder):
    return distribution.iqr_filter(distribution.score_split(D.posts(spark, folder)))


@query
def length_histogram(spark, folder):
    return distribution.length_histogram(distribution.iqr_filter(distribution.score_split(D.posts(spark, folder))))


@query
def distinct_values(spark, folder):
    return distribution.distinct_values(D.table(spark, folder, "documents"), "source")


def _judged_documents(spark, folder):
    """Quality labels against a length rule."""
    labels = D.table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    rule = D.table(spark, folder, "documents").select("doc_id", (F.col("n_chars") > 1500).cast("int").alias("prediction"))
    return labels.join(rule, "doc_id")


@query
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_judged_documents(spark, folder))


@query
def binary_metrics(spark, folder):
    return evaluation.binary_metrics(_judged_documents(spark, folder))


@query
def classification_report(spark, folder):
    return evaluation.classification_report(_judged_documents(spark, folder))


@query
def mean_word_vector(spark, folder):
    means = vectors.mean_word_vector(
        D.documents(spark, folder),
        X.text("text"),
        "doc_id",
        D.word_vectors(spark, folder),
        D.vector_width(spark, folder),
    )
    return long_form(means, "doc_id", "vector")


# --- quality features -----------------------------------------------------

@query
def qf_lengths(spark, folder):
    f = quality.row_features()
    return D.documents_as_posts(spark, folder).select("Id", *[f[c].alias(c) for c in ("title_len", "body_len")])


@query
def qf_question_marks(spark, folder):
    f = quality.row_features()
    names = ("title_ends_with_qmark", "body_ends_with_qmark")
    return D.documents_as_posts(spark, folder).select("Id", *[f[c].alias(c) for c in names])


@query
def qf_caps_ratio(spark, folder):
    return D.documents_as_posts(spark, folder).select("Id", X.caps_ratio("Title").alias("title_caps_ratio"))


@query
def qf_flesch(spark, folder):
    scored = textstats.readability(
        D.documents_as_posts(spark, folder), X.concat_text("Title", "Body"), "Id", D.lexicon(spark, folder)
    )
    return scored.select("Id", "flesch_score")


@query
def qf_action_density(spark, folder):
    return D.documents_as_posts(spark, folder).select("Id", X.action_density("Body").alias("action_verbs_density"))


@query
def quality_features(spark, folder):
    return quality.quality_features(D.posts(spark, folder), D.lexicon(spark, folder))


# --- text statistics ------------------------------------------------------

@query
def clean_text_ascii(spark, folder):
    return D.documents(spark, folder).select("doc_id", X.clean_ascii("text").alias("text"))


@query
def tokenize_sentences(spark, folder):
    split = textstats.sentence_tokens(D.documents(spark, folder), "text", "doc_id")
    return split.select("doc_id", "sentence_no", F.array_join("tokens", " ").alias("tokens"))


def _abbreviations(spark, folder):
    return sentences.abbreviations(materialise(sentences.stop_counts(D.documents(spark, folder), "text")))


@query
def learned_abbreviations(spark, folder):
    return _abbreviations(spark, folder).select("word", "n", "n_stop", F.round("score", 4).alias("score"))


@query
def sentences_with_abbreviations(spark, folder):
    """Sentences per document and their longest, where learned abbreviations end none."""
    split = sentences.split_sentences(D.documents(spark, folder), "text", "doc_id", materialise(_abbreviations(spark, folder)))
    return split.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sentences"), F.max(F.length("sentence")).cast("bigint").alias("longest"))


@query
def word_usage(spark, folder):
    words = fixed.CONJUNCTIONS + ["the", "que", "der"]
    return D.documents(spark, folder).select("doc_id", X.token_usage(X.text("text"), words).alias("uses"))


@query
def unique_word_fraction(spark, folder):
    return D.documents(spark, folder).select("doc_id", X.unique_fraction(X.text("text")).alias("unique_fraction"))


@query
def syllable_count(spark, folder):
    return textstats.syllable_count(D.documents(spark, folder), "text", "doc_id", D.lexicon(spark, folder))


@query
def word_count(spark, folder):
    return D.documents(spark, folder).select("doc_id", X.word_count(X.text("text")).alias("words"))


@query
def flesch_score(spark, folder):
    report = textstats.text_report(D.documents(spark, folder), "text", "doc_id", D.lexicon(spark, folder))
    return report.select("doc_id", "sentences", "words", "syllables", "flesch_score")


@query
def text_report(spark, folder):
    cleaned = D.documents(spark, folder).withColumn("text", X.clean_ascii("text"))
    return textstats.text_report(cleaned, "text", "doc_id", D.lexicon(spark, folder))


# --- fitted transforms ----------------------------------------------------

@query
def impute_median(spark, folder):
    gaps = D.table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price")
    )
    median = structured.fit_medians(gaps, ["price"])["price"]
    return gaps.select("o_orderkey", structured.impute("price", median).alias("price"))


@query
def standard_scale(spark, folder):
    orders = D.table(spark, folder, "orders")
    mean, deviation = structured.fit_scales(orders, {"price": F.col("o_totalprice")})["price"]
    return orders.select("o_orderkey", structured.scale(F.col("o_totalprice"), mean, deviation).alias("price"))


@query
def impute_constant(spark, folder):
    return D.posts(spark, folder).select("Id", structured.category("OwnerUserId").alias("OwnerUserId"))


@query
def one_hot_topk(spark, folder):
    part = D.table(spark, folder, "part")
    slots = {}
    for c in ("p_brand", "p_type", "p_name"):
        slots.update(structured.one_hot(c, *structured.fit_categories(part, c)))
    cells = F.array(*[F.struct(F.lit(n).alias("slot"), v.alias("value")) for n, v in slots.items()])
    return part.select("p_partkey", F.inline(cells))


@query
def date_parts(spark, folder):
    dated = D.table(spark, folder, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderdate").cast("string").alias("text_date"))
    return structured.extract_dates(dated, ["o_orderdate", "text_date"])


@query
def structured_features(spark, folder):
    orders = D.table(spark, folder, "orders").withColumn(
        "price", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    )
    stage = PostFeatures(
        idCol="o_orderkey", numericCols=["price"], categoricalCols=["o_orderpriority", "o_orderstatus"], dateCols=["o_orderdate"]
    )
    out = stage.fit(orders).transform(orders)
    names = F.array(*[F.lit(n) for n in vector_names(out)])
    return long_form(out.withColumn("v", vector_to_array("features")), "o_orderkey", "v").select(
        "o_orderkey", F.element_at(names, F.col("dim") + 1).alias("slot"), "value"
    )


@query
def svd_reduce(spark, folder):
    """Mean word vectors of all documents, reduced to 16 components."""
    means = materialise(
        vectors.mean_word_vector(
            D.documents(spark, folder), X.text("text"), "doc_id", D.word_vectors(spark, folder), D.vector_width(spark, folder)
        )
    )
    basis = vectors.fit_svd(means, "vector", 16)
    return long_form(means.withColumn("vector", vectors.project(F.col("vector"), basis)), "doc_id", "vector")


def _features(spark, folder) -> PostFeatures:
    """The default feature set, over word tables stored where all executors can read them."""
    paths = {}
    for name, table in (("lexicon", D.lexicon(spark, folder)), ("vectors", D.word_vectors(spark, folder))):
        paths[name] = fresh_path(spark, name)
        table.write.parquet(paths[name])
    return PostFeatures(textCols=["Title", "Body"], qualityFeatures=True, **paths)


def _train_test(spark, folder):
    return splitting.split_by_group(D.posts(spark, folder))


@query
def feature_matrix(spark, folder):
    posts = D.posts(spark, folder)
    out = _features(spark, folder).fit(posts).transform(posts)
    return long_form(out.withColumn("v", vector_to_array("features")), "Id", "v")


@query
def feature_matrix_full_width(spark, folder):
    """The feature matrix with all word-vector dimensions kept."""
    posts = D.posts(spark, folder)
    stage = _features(spark, folder)
    stage.set(stage.components, 0)
    return long_form(stage.fit(posts).transform(posts).withColumn("v", vector_to_array("features")), "Id", "v")


@query
def feature_names(spark, folder):
    posts = D.posts(spark, folder)
    out = _features(spark, folder).fit(posts).transform(posts)
    names = list(enumerate(vector_names(out)))
    return spark.createDataFrame(names, "slot bigint, name string")


@query
def fit_train_apply_test(spark, folder):
    train, test = _train_test(spark, folder)
    _, applied, _ = training.fit_train_apply_test(_features(spark, folder), train, test)
    return long_form(applied.withColumn("v", vector_to_array("features")), "Id", "v")


@query
def fit_train_apply_test_full_width(spark, folder):
    """Test rows, all word-vector dimensions kept, scaled by what the training rows show."""
    train, test = _train_test(spark, folder)
    stage = _features(spark, folder)
    stage.set(stage.components, 0)
    _, applied, _ = training.fit_train_apply_test(stage, train, test)
    return long_form(applied.withColumn("v", vector_to_array("features")), "Id", "v")


# --- splitting and sampling -----------------------------------------------

def _sides(train, test):
    return train.select("Id", "OwnerUserId", F.lit("train").alias("side")).union(
        test.select("Id", "OwnerUserId", F.lit("test").alias("side"))
    )


@query
def fill_missing_groups(spark, folder):
    return splitting.fill_missing_groups(D.posts(spark, folder)).select("Id", "OwnerUserId")


@query
def split_by_group(spark, folder):
    return _sides(*splitting.split_by_group(D.posts(spark, folder)))


@query
def split_by_group_without_ids(spark, folder):
    """Posts of which a third have lost their ids: rows on both sides, none of them lost."""
    lost = F.when(F.col("Id") % 3 != 0, F.col("Id")).alias("Id")
    return _sides(*splitting.split_by_group(D.posts(spark, folder).select(lost, "OwnerUserId", "Body")))


@query
def split_by_group_exact(spark, folder):
    return _sides(*splitting.split_by_group(D.posts(spark, folder), exact=True))


@query
def group_overlap(spark, folder):
    return splitting.group_overlap(*splitting.split_by_group(D.posts(spark, folder)))


@query
def sample_questions(spark, folder):
    """A thousand questions, or all where there are fewer."""
    asked = matching.questions(D.posts(spark, folder))
    n = min(fixed.SAMPLE_SIZE, asked.limit(fixed.SAMPLE_SIZE).count())
    return splitting.sample_rows(asked, n).select("Id", "Score")


# --- label balance --------------------------------------------------------

@query
def class_weights(spark, folder):
    return evaluation.class_weights(labeling.labeled_training_set(D.posts(spark, folder))).select("label", "weight")


# --- models ---------------------------------------------------------------

def _trained(spark, folder, algorithm="random_forest", quality_labels=True):
    train, test = _train_test(spark, folder)
    return training.train_evaluate(train, test, _features(spark, folder), algorithm, quality_labels=quality_labels)


def _answers(predictions: DataFrame) -> DataFrame:
    """Predictions without the answers themselves, but whether each is 0 or 1."""
    return predictions.select("Id", "label", F.col("prediction").isin(0, 1).alias("answered"))


@query
def train_random_forest(spark, folder):
    return _answers(_trained(spark, folder).predictions)


@query
def train_logistic(spark, folder):
    return _answers(_trained(spark, folder, "logistic_regression").predictions)


@query
def predict_quality(spark, folder):
    """Quality predicted for every post, labelled or not."""
    model = _trained(spark, folder, "logistic_regression").model
    return models.predict(model, D.posts(spark, folder)).select("Id", F.col("prediction").isin(0, 1).alias("answered"))


@query
def train_evaluate(spark, folder):
    """What a whole run leaves: its stages, the support and the matrix of its test side, and whether the
    stored report, metrics and out-of-bag score follow from the stored predictions."""
    train, test = _train_test(spark, folder)
    params = {**training.FOREST, "oob_score": True, "trees_per_bag": 10}
    run = training_run.run_training(spark, fresh_path(spark, "run"), train, test, _features(spark, folder), params=params)
    hit, predicted, actual = F.sum(F.col("label") * F.col("prediction")), F.sum("prediction"), F.sum("label")
    anew = run.predictions.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")), hit, predicted, actual).first()
    accuracy, hit, predicted, actual = anew
    precision, recall = (hit / n if n else 0.0 for n in (predicted, actual))
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    metrics = run.metrics.first()
    report = {r["name"]: r for r in run.report.collect()}
    high = report["High Quality"]
    pairs = [(metrics["accuracy"], accuracy), (metrics["precision"], precision), (metrics["recall"], recall), (metrics["f1_score"], f1)]
    pairs += [(high["precision"], precision), (high["recall"], recall), (high["f1_score"], f1), (report["accuracy"]["f1_score"], accuracy)]
    checks = {"follows": all(abs(a - b) < 1e-9 for a, b in pairs), "out of bag": run.oob_score is not None and 0 <= run.oob_score <= 1}
    stages = run.ledger.select(F.lit("stage").alias("part"), F.col("stage").alias("name"), (F.col("seconds") > 0).cast("bigint").alias("n"))
    support = run.report.select(F.lit("support"), "name", F.col("support").cast("bigint"))
    matrix = run.matrix.groupBy("label").agg(F.sum("n").cast("bigint").alias("n"))
    rows = stages.union(support).union(matrix.select(F.lit("matrix"), F.col("label").cast("string"), "n"))
    return rows.union(spark.createDataFrame([("check", k, int(v)) for k, v in checks.items()], "part string, name string, n bigint"))


@query
def save_model(spark, folder):
    """Whether the fitted model and its saved copy predict the same."""
    model, path = _trained(spark, folder, "logistic_regression").model, fresh_path(spark, "model")
    model_files.save_model(model, path)
    posts = D.posts(spark, folder)
    fitted = models.predict(model, posts).select("Id", "prediction")
    loaded = models.predict(model_files.load_model(path), posts).select("Id", F.col("prediction").alias("reloaded"))
    return fitted.join(loaded, "Id").select("Id", (F.col("prediction") == F.col("reloaded")).cast("int").alias("same"))


@query
def save_model_metadata(spark, folder):
    path, median = fresh_path(spark, "metadata"), labeling.score_median(D.posts(spark, folder))
    model_files.save_model_metadata(spark, f"{path}/rules", "random_forest", None)
    model_files.save_model_metadata(spark, f"{path}/median", "random_forest", median)
    saved = model_files.load_model_metadata(spark, f"{path}/rules").union(model_files.load_model_metadata(spark, f"{path}/median"))
    return saved.withColumn("dated", F.col("training_date").isNotNull()).drop("training_date")


# --- map of posts ---------------------------------------------------------

def _embeddings(spark, folder):
    return D.table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))


@query
def knn_graph(spark, folder):
    return neighbors.knn_graph(_embeddings(spark, folder), "vec_id", "vector")


@query
def knn_graph_cosine(spark, folder):
    return neighbors.knn_graph(_embeddings(spark, folder), "vec_id", "vector", metric="cosine")


def _vectors(spark, folder):
    return _embeddings(spark, folder).select("vec_id", array_to_vector("vector").alias("features"))


def _measured(points: DataFrame, weight, near: DataFrame | None, values: list[float]) -> DataFrame:
    """Rows of `id, weight, coordinates` with 0/1 answers, each worked out anew from the coordinates.

    `settled`: the layout's equation holds for every axis, A v = value * v, up to a length of
    0.02; `centred` and `orthogonal` are the weighted means and products of the axes.
    """
    axes = [F.get("coordinates", F.lit(i)) for i in range(2)]
    total = F.sum(weight)
    sums = [F.sum(weight * a) / total for a in axes]
    cross = F.sum(weight * axes[0] * axes[1]) / F.sqrt(F.sum(weight * axes[0] ** 2) * F.sum(weight * axes[1] ** 2))
    m = points.agg(*[s.alias(f"m{i}") for i, s in enumerate(sums)], cross.alias("cross")).first()
    centred, orthogonal = all(abs(m[f"m{i}"]) < 1e-6 for i in range(2)), abs(m["cross"]) < 1e-6
    settled = True
    if near is not None:  # for vectors v = coordinates * sqrt(degree) of length 1
        of = points.select(F.col("id").alias("src"), "coordinates", "weight")
        to = points.select(F.col("id").alias("dst"), F.col("coordinates").alias("own"), F.col("weight").alias("w"))
        sent = near.join(of, "src").groupBy("dst").agg(*[F.sum(a).alias(f"s{i}") for i, a in enumerate(axes)])
        gaps = [(F.col(f"s{i}") / F.sqrt("w") - F.lit(values[i]) * F.sqrt("w") * F.get("own", F.lit(i))) ** 2 for i in range(2)]
        lengths = [F.sum(F.col("w") * F.get("own", F.lit(i)) ** 2) for i in range(2)]
        found = sent.join(to, "dst").agg(*[F.sqrt(F.sum(g) / n).alias(f"r{i}") for i, (g, n) in enumerate(zip(gaps, lengths))]).first()
        settled = all(r < 0.02 for r in found)
    flags = {"centred": centred, "orthogonal": orthogonal, "settled": settled}
    return points.select(F.col("id").alias("vec_id"), "weight", *[F.lit(int(v)).alias(n) for n, v in flags.items()])


@query
def project_2d(spark, folder):
    """Rows of the map with their degrees in the neighbour graph, and what holds of its axes."""
    graph = materialise(neighbors.knn_graph(_embeddings(spark, folder), "vec_id", "vector"))
    done = spectral.spectral_layout(graph, "vec_id")
    points = done.points.select(F.col("vec_id").alias("id"), F.col("degree").alias("weight"), "coordinates")
    near = spectral.undirected(graph, "vec_id", "neighbor")
    return _measured(points, F.col("weight"), near, done.values).withColumnRenamed("weight", "degree")


@query
def project_2d_points(spark, folder):
    return projection.project_2d(_vectors(spark, folder), "features", "vec_id")


@query
def project_2d_linear(spark, folder):
    return projection.project_2d(_vectors(spark, folder), "features", "vec_id", "linear")


@query
def project_linear_axes(spark, folder):
    """The rows of a linear map in three dimensions, and what holds of its first axes."""
    at = projection.project(_vectors(spark, folder), "features", "vec_id", 3, "linear")
    points = at.select(F.col("vec_id").alias("id"), F.lit(1).alias("weight"), "coordinates")
    return _measured(points, F.col("weight"), None, []).select("vec_id", "centred", "orthogonal")


@query
def post_map(spark, folder):
    """The map's rows, with whether they have their two coordinates."""
    shown = maps.post_map(D.posts(spark, folder), _features(spark, folder))
    placed = (F.col("x").isNotNull() & ~F.isnan("x") & F.col("y").isNotNull() & ~F.isnan("y")).alias("placed")
    return shown.select("Id", "Title", "Score", "cluster", "label_store", placed)


@query
def post_map_points(spark, folder):
    shown = maps.post_map(D.posts(spark, folder), _features(spark, folder), n_components=3)
    return shown.select("Id", "x", "y", "z")


@query
def post_map_rows(spark, folder):
    """The rows of the map, all of which have coordinates."""
    shown = maps.post_map(D.posts(spark, folder), _features(spark, folder))
    return shown.where("x is not null and y is not null").select("Id", "Title", "Score", "cluster", "label_store")


# --- manual labels --------------------------------------------------------

def _raw_stores(spark, folder):
    store = F.when(F.col("event_type") == "error", "not json").when(F.col("event_type") != "click", F.col("props"))
    return D.table(spark, folder, "events").select("event_id", store.alias("label_store"))


def _messy_edits(spark, folder):
    key = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("  "), F.upper("key"), F.lit(" ")))
        .when(F.col("event_id") % 3 == 1, F.col("key"))
        .otherwise(F.when(F.col("key") == "view", F.lit("question_QUALITY")).otherwise(F.lit(" ")))
    )
    return D.label_events(spark, folder).withColumn("key", key)


def _labeled_users(spark, folder):
    """Users with a store that already holds a `click` label and one of its own."""
    store = F.concat(F.lit('{"click": "old", "u'), F.col("Id") % 3, F.lit('": "kept"}'))
    users = D.label_events(spark, folder).select("Id").distinct()
    return users.withColumn("label_store", F.when(F.col("Id") % 5 != 0, store))


def _applied(spark, folder):
    return annotate.apply_labels(_labeled_users(spark, folder), D.label_events(spark, folder))


@query
def init_label_store(spark, folder):
    return _raw_stores(spark, folder).select("event_id", annotate.init_store().alias("label_store"))


@query
def canonical_label_key(spark, folder):
    registry = annotate.label_keys(_labeled_users(spark, folder))
    return annotate.canonical_keys(_messy_edits(spark, folder), registry).select("event_id", "key")


@query
def apply_labels(spark, folder):
    return _applied(spark, folder).select("Id", F.explode(annotate.store_map()).alias("key", "value"))


@query
def merged_label_table(spark, folder):
    """The same labels from a table of 16 buckets, merged three times, with edits that come late."""
    table = LabelTable(spark, fresh_path(spark, "labels"), buckets=16)
    table.add_stores(_labeled_users(spark, folder))
    for turn in (2, 0, 1):
        table.merge(D.label_events(spark, folder).where(F.col("event_id") % 3 == turn))
    return table.stores().select("Id", F.explode(annotate.store_map()).alias("key", "value"))


@query
def label_keys(spark, folder):
    return annotate.label_keys(_applied(spark, folder))


@query
def expand_labels(spark, folder):
    return annotate.expand_labels(_applied(spark, folder)).drop("label_store")


@query
def single_label(spark, folder):
    edits = D.label_events(spark, folder).where(F.col("key") == "purchase")
    return annotate.single_label(_labeled_users(spark, folder).select("Id"), edits)
