"""Classifiers over the feature vector."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.operators.evaluation import class_weights
from postgauge.operators.forest import GROWN_ROWS, TREES_PER_BAG, BaggedForest, fit_bagged_forest, grow_stored, out_of_bag_score, transformed
from postgauge.operators.whole_forest import grow_whole
from postgauge.session import materialise

# The deepest tree Spark grows; stands in for "no limit".
DEEPEST = 30
# Rows up to which Spark's own forest is grown. For every node, however few its rows, it sums up the counts of all bins,
# and of more than 10,000 rows it takes its thresholds from a sample.
SPARK_ROWS = 1_000


def make_classifier(algorithm: str = "random_forest", seed: int = fixed.SEED, rows: int = 1, params: dict | None = None):
    """An unfitted classifier; `rows` turns the L2 strength per data set into one per row."""
    params = params or {}
    if algorithm == "random_forest":
        if (params.get("max_depth") or 0) > DEEPEST:
            raise ValueError(f"max_depth is at most {DEEPEST}, or None for the deepest")
        return RandomForestClassifier(
            numTrees=params.get("n_estimators", 100),
            maxDepth=params.get("max_depth") or DEEPEST,
            # A node is split from min_samples_split rows on; its children may then hold one row.
            minInstancesPerNode=max(1, params.get("min_samples_split", 2) // 2),
            seed=seed,
        )
    if algorithm == "logistic_regression":
        return LogisticRegression(
            maxIter=1000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False
        )
    raise ValueError(f"Unknown algorithm: {algorithm}; choose random_forest or logistic_regression")


def fit_classifier(
    df: DataFrame,
    algorithm: str = "random_forest",
    seed: int = fixed.SEED,
    params: dict | None = None,
    label: str = "label",
    features: str = "features",
    row_id: str | None = None,
) -> Model:
    """Fit on rows with a 0/1 label; `class_weight: balanced` weighs classes by their size.

    A forest of more than `SPARK_ROWS` rows is grown from all of them by tasks, its bags chosen by `row_id` where there
    is one; a smaller one of more than `GROWN_ROWS` rows times trees is grown and stored lot by lot.
    """
    params = params or {}
    rows = df.count()
    if algorithm == "random_forest" and rows > SPARK_ROWS:
        grower = make_classifier(algorithm, seed, rows, params).setLabelCol(label).setFeaturesCol(features)
        return grow_whole(_numbered(df, row_id, label, features), grower, row_id, shares_of(df, label, params), grower.getNumTrees() > 1)[0]
    data = df.select(F.col(label).cast("double").alias(label), features)
    classifier = make_classifier(algorithm, seed, rows, params).setLabelCol(label).setFeaturesCol(features)
    if params.get("class_weight") == "balanced":
        data = data.withColumn("weight", balanced(data, label))
        classifier = classifier.setWeightCol("weight")
    if algorithm == "random_forest" and rows * classifier.getNumTrees() > GROWN_ROWS and classifier.getNumTrees() > 1:
        ordered = data.repartition(1).sortWithinPartitions(vector_to_array(features), label)  # few rows, whose order decides their bags
        return grow_stored(materialise(ordered), classifier, max(1, GROWN_ROWS // rows))
    return classifier.fit(data)


def _numbered(df: DataFrame, row_id: str | None, label: str, features: str) -> DataFrame:
    """Stored rows with what a forest is grown from, and their numbers."""
    return materialise(df.select(*[row_id] if row_id else [], F.col(label).cast("int").alias(label), features, F.monotonically_increasing_id().alias("_row")))


def shares_of(df: DataFrame, label: str, params: dict) -> dict[int, float]:
    """The weights of classes that the parameters ask for."""
    rows = class_weights(df, label).collect() if params.get("class_weight") == "balanced" else []  # one row for each class
    return {int(r[label]): r["weight"] for r in rows}


def balanced(df: DataFrame, label: str = "label") -> Column:
    """A row's weight by the size of its class."""
    weight = F.lit(1.0)
    for r in class_weights(df, label).collect():  # one row for each class
        weight = F.when(F.col(label) == r[label], r["weight"]).otherwise(weight)
    return weight


def fit_forest_with_score(
    df: DataFrame, row_id: str, seed: int = fixed.SEED, params: dict | None = None, label: str = "label", features: str = "features"
) -> BaggedForest:
    """A forest of known bags and its out-of-bag score: `oob_score` of the parameters."""
    params = params or {}
    grower = make_classifier("random_forest", seed, params=params).setLabelCol(label).setFeaturesCol(features)
    if df.count() > SPARK_ROWS:
        return _whole_with_score(df, grower, row_id, params)
    weight = balanced(df, label) if params.get("class_weight") == "balanced" else None
    return fit_bagged_forest(df, grower, row_id, weight, params.get("trees_per_bag", TREES_PER_BAG), seed)


def _whole_with_score(df: DataFrame, grower: RandomForestClassifier, row_id: str, params: dict) -> BaggedForest:
    label = grower.getLabelCol()
    data = _numbered(df, row_id, label, grower.getFeaturesCol())
    forest, answers = grow_whole(data, grower, row_id, shares_of(data, label, params), True, params.get("trees_per_bag", TREES_PER_BAG), score=True)
    answers = answers.select(F.col("row").alias("_row"), F.col("trees").cast("int").alias("_trees"), "ones")
    share = F.try_divide("ones", "_trees").alias("share")
    voters = data.select("_row", row_id, label).join(answers, "_row", "left")
    votes = materialise(voters.select(row_id, label, F.coalesce("_trees", F.lit(0)).alias("trees"), share))
    return BaggedForest(PipelineModel([forest]), votes, out_of_bag_score(votes, label))


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Rows with a whole-number `prediction`."""
    scored = transformed(model, df).drop("rawPrediction", "probability")
    return scored.withColumn("prediction", F.col("prediction").cast("int"))
