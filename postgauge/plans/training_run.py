"""The whole training run, stage by stage, each recorded as it ends."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.operators.evaluation import binary_metrics, classification_report, confusion_matrix
from postgauge.operators.models import predict
from postgauge.plans.ledger import Ledger, digest_of, table_digest
from postgauge.plans.training import FOREST, bounded_rows, grow, labeled_sides
from postgauge.sources.model_files import save_model, save_model_metadata
from postgauge.stages.post_features import PostFeatures, PostFeaturesModel

STAGES = ["load", "features", "training", "evaluation", "saving"]
FACTS = "fit_rows bigint, oob_score double"


@dataclass
class TrainingRun:
    """`ledger` has a row for each of the five stages with its seconds; `model_path` holds the saved
    pipeline of features and classifier, `metadata_path` what is known about it."""

    ledger: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    report: DataFrame
    matrix: DataFrame
    fit_rows: int
    median_threshold: float | None
    oob_score: float | None
    model_path: str
    metadata_path: str


def run_training(
    spark: SparkSession,
    folder: str,
    train: DataFrame,
    test: DataFrame,
    features: PostFeatures,
    algorithm: str = "random_forest",
    params: dict | None = None,
    seed: int = fixed.SEED,
    quality_labels: bool = True,
    max_fit_rows: int | None = None,
) -> TrainingRun:
    """Label, featurise, train, evaluate and save, all below `folder`.

    Every stage reads what the one before wrote. Its digest covers its input, down to the rows of `train`
    and `test`, and its settings; where the ledger has that digest, the stage's results are
    read and nothing is done again. So a run begun anew after a lost driver repeats at most
    the stage it was in, and other data, settings or seeds run their own stages. Word tables
    count by the names they are opened by.
    """
    params = (FOREST if algorithm == "random_forest" else {}) if params is None else params
    ledger = Ledger(spark, folder)
    row_id, output = features.getOrDefault("idCol"), features.getOrDefault("outputCol")
    settings = {p.name: v for p, v in features.extractParamMap().items()}

    def load(path: str) -> None:
        *sides, threshold = labeled_sides(train, test, quality_labels)
        label = F.col("label").cast("int").alias("label")
        for name, rows in zip(("train", "test"), sides, strict=True):
            features.prepare(rows).select(row_id, label, *features.inputs()).write.mode("overwrite").parquet(f"{path}/{name}")
        spark.createDataFrame([(threshold,)], "threshold double").write.mode("overwrite").parquet(f"{path}/threshold")

    def featurise(path: str) -> None:
        sides = {name: spark.read.parquet(f"{loaded}/{name}") for name in ("train", "test")}
        model = features.fit(sides["train"])
        model.write().overwrite().save(f"{path}/model")
        for name, rows in sides.items():
            model.transform(rows).select(row_id, "label", output).write.mode("overwrite").parquet(f"{path}/{name}")

    def fit(path: str) -> None:
        rows = spark.read.parquet(f"{vectors}/train")
        rows, n = bounded_rows(rows, rows.count(), row_id, algorithm, seed, max_fit_rows)
        grown, score = grow(rows, row_id, algorithm, seed, params, output)
        save_model(PipelineModel([grown]), f"{path}/model")
        spark.createDataFrame([(n, score)], FACTS).write.mode("overwrite").parquet(f"{path}/facts")

    @cache
    def classifier() -> PipelineModel:
        return PipelineModel.load(f"{trained}/model")

    def evaluate(path: str) -> None:
        scored = predict(classifier(), spark.read.parquet(f"{vectors}/test"))
        scored.select(row_id, "label", "prediction").write.mode("overwrite").parquet(f"{path}/predictions")
        stored = spark.read.parquet(f"{path}/predictions")
        for name, measure in (("metrics", binary_metrics), ("report", classification_report), ("matrix", confusion_matrix)):
            measure(stored).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    def save(path: str) -> None:
        stages = [PostFeaturesModel.load(f"{vectors}/model"), *classifier().stages]
        save_model(PipelineModel(stages), f"{path}/model")
        save_model_metadata(spark, f"{path}/metadata", algorithm, threshold)

    digest = digest_of(table_digest(train), table_digest(test), quality_labels, settings)
    loaded = ledger.stage("load", digest, load)
    threshold = spark.read.parquet(f"{loaded}/threshold").first()[0]
    vectors = ledger.stage("features", digest := digest_of(digest, "features"), featurise)
    digest = digest_of(digest, algorithm, params, seed, max_fit_rows)
    trained = ledger.stage("training", digest, fit)
    judged = ledger.stage("evaluation", digest := digest_of(digest, "evaluation"), evaluate)
    saved = ledger.stage("saving", digest_of(digest, "saving"), save)
    results = (spark.read.parquet(f"{judged}/{name}") for name in ("predictions", "metrics", "report", "matrix"))
    n, score = spark.read.parquet(f"{trained}/facts").first()
    return TrainingRun(ledger.rows(), *results, n, threshold, score, f"{saved}/model", f"{saved}/metadata")
