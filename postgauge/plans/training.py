"""Label, featurise, train, evaluate."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.operators.evaluation import binary_metrics
from postgauge.operators.labeling import labeled_training_set, median_labeled_set
from postgauge.operators.models import fit_classifier, fit_forest_with_score, predict
from postgauge.operators.splitting import split_by_group
from postgauge.session import materialise
from postgauge.stages.post_features import PostFeatures

FOREST = {"n_estimators": 100, "class_weight": "balanced", "max_depth": None, "min_samples_split": 2}


@dataclass
class Training:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    fit_rows: int
    median_threshold: float | None = None
    oob_score: float | None = None
    seconds: dict[str, float] = field(default_factory=dict)


def fit_train_apply_test(features: PostFeatures, train: DataFrame, test: DataFrame):
    """Fit on the training rows only; featurise both sides. Returns (train, test, model)."""
    model = features.fit(train)
    return model.transform(train), model.transform(test), model


def labeled_sides(train: DataFrame, test: DataFrame, quality_labels: bool) -> tuple[DataFrame, DataFrame, float | None]:
    """Both sides with labels: by the rules, or by the training side's median score."""
    if quality_labels:
        return labeled_training_set(train), labeled_training_set(test), None
    train, threshold = median_labeled_set(train)
    return train, median_labeled_set(test, threshold)[0], threshold


def bounded_rows(rows: DataFrame, n: int, row_id: str, algorithm: str, seed: int, max_fit_rows: int | None) -> tuple[DataFrame, int]:
    """The rows a model is grown from, of `n`, and their number: see `train_evaluate`."""
    if algorithm != "random_forest" or max_fit_rows is None or n <= max_fit_rows:
        return rows, n
    bound = int(max_fit_rows / n * (1 << 31))
    kept = rows.where(F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(1 << 31)) < bound)
    return kept, kept.select(row_id).count()


def grow(rows: DataFrame, row_id: str, algorithm: str, seed: int, params: dict, features: str) -> tuple[Model, float | None]:
    """The classifier, and its out-of-bag score where `oob_score` asks for one."""
    if algorithm == "random_forest" and params.get("oob_score"):
        forest = fit_forest_with_score(rows, row_id, seed, params, features=features)
        return forest.model, forest.oob_score
    return fit_classifier(rows, algorithm, seed, params, features=features, row_id=row_id), None


def train_evaluate(
    train: DataFrame,
    test: DataFrame,
    features: PostFeatures,
    algorithm: str = "random_forest",
    params: dict | None = None,
    seed: int = fixed.SEED,
    quality_labels: bool = True,
    max_fit_rows: int | None = None,
) -> Training:
    """Train on one side, judge on the other.

    Everything is fitted on all training rows. Only a caller that gives `max_fit_rows` has a forest
    grown from about that many, chosen by a seeded hash of their ids; features are fitted, and
    the model is judged, on all rows even then. `fit_rows` tells how many were used. With `oob_score` among the
    parameters the forest's bags are known, and the rows left out of them give that score.

    What comes from the texts is stored first: fitting, training and a lost executor
    all go back to those small rows, and every text is read once.
    """
    if params is None:
        params = FOREST if algorithm == "random_forest" else {}
    seconds, clock = {}, time.time()

    def lap(name: str) -> None:
        nonlocal clock
        seconds[name], clock = time.time() - clock, time.time()

    train, test, threshold = labeled_sides(train, test, quality_labels)
    row_id = features.getOrDefault("idCol")
    label = F.col("label").cast("int").alias("label")
    train, test = (materialise(features.prepare(rows).select(row_id, label, *features.inputs())) for rows in (train, test))
    train_x, test_x, feature_model = fit_train_apply_test(features, train, test)
    lap("features")
    train_x, fit_rows = bounded_rows(train_x, train.count(), row_id, algorithm, seed, max_fit_rows)
    classifier, oob_score = grow(train_x, row_id, algorithm, seed, params, features.getOrDefault("outputCol"))
    lap("training")
    predictions = materialise(predict(classifier, test_x).select(row_id, "label", "prediction"))
    metrics = binary_metrics(predictions)
    lap("evaluation")
    return Training(PipelineModel([feature_model, classifier]), predictions, metrics, fit_rows, threshold, oob_score, seconds)


def holdout_accuracy(
    train: DataFrame, features: PostFeatures, algorithm: str = "random_forest", params: dict | None = None, group: str = "OwnerUserId"
) -> float:
    """Accuracy on authors kept out of the fit, which an out-of-bag score does not keep apart."""
    inner, kept_out = split_by_group(train, group)
    return train_evaluate(inner, kept_out, features, algorithm, params).metrics.first()["accuracy"]
