"""A random forest whose bags are known, so that rows left out of a bag can judge it.

How often a row is in a bag is a Poisson number from a hash of its id and the bag, so it is
the same in every run, whatever the partitions, and needs no table. The trees of a bag are
grown on its rows with these numbers as weights; the forest's answer is the mean of all trees'
class shares. A row is out of a bag where its number is 0, and its out-of-bag answer is
the mean over those bags alone.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCols, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.session import fresh_path, materialise

TREES_PER_BAG = 1
TOGETHER = 12  # bags grown at a time
# Rows of a task that grows or asks a bag. Every task sums up all nodes of a level and is sent all nodes of the bag, so
# tasks that are many for their rows cost more than they share.
TASK_ROWS = 1 << 18
# Rows times trees that are grown together: deep trees have about a node for each row, and live on the driver.
GROWN_ROWS = 500_000
_UNIT = 1 << 52


def _share(votes: str) -> Column:
    """Sum over a bag's trees of their share of class 1."""
    return F.get(vector_to_array(votes), F.lit(1))


class VoteMean(Transformer, HasInputCols, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The class with the larger mean share over all votes columns, which it takes away."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.getInputCols()
        arrays = [vector_to_array(n) for n in names]
        ones, all_ = (sum(f(a) for a in arrays) for f in (lambda a: F.get(a, F.lit(1)), lambda a: F.get(a, F.lit(0)) + F.get(a, F.lit(1))))
        return df.withColumn(self.getPredictionCol(), (2 * ones > all_).cast("double")).drop(*names)


def _stages(model: Model) -> list:
    return [s for stage in model.stages for s in _stages(stage)] if isinstance(model, PipelineModel) else [model]


def transformed(model: Model, df: DataFrame) -> DataFrame:
    """What `model.transform` gives. Bags that end in a `VoteMean` are asked at once, each by few tasks of its
    own, and their rows stored: in one plan every task would hold the nodes of all bags."""
    *before, mean = _stages(model)
    if not isinstance(mean, VoteMean):
        return model.transform(df)
    names = mean.getInputCols()
    bags = before[len(before) - len(names) :]
    row = f"row_{uuid.uuid4().hex}"  # clashes with no column
    stored = materialise(PipelineModel(before[: len(before) - len(names)]).transform(df).withColumn(row, F.monotonically_increasing_id()))
    tasks = max(1, math.ceil(stored.count() / TASK_ROWS))

    @inheritable_thread_target(df.sparkSession)
    def ask(bag: int) -> DataFrame:
        features = bags[bag].getFeaturesCol()
        cast = bags[bag].transform(stored.select(row, F.col(features).alias(features)).coalesce(tasks)).withColumn("votes", vector_to_array(names[bag]))
        part = F.struct(F.lit(bag).alias("bag"), F.get("votes", F.lit(0)).alias("zeros"), F.get("votes", F.lit(1)).alias("ones"))
        return materialise(cast.select(F.col(row), part.alias("part")))

    with ThreadPoolExecutor(TOGETHER) as pool:
        cast = list(pool.map(ask, range(len(bags))))
    parts = reduce(DataFrame.unionByName, cast).groupBy(row).agg(F.sort_array(F.collect_list("part")).alias("parts"))  # one for each bag
    ones = F.aggregate("parts.ones", F.lit(0.0), lambda a, x: a + x)
    every = F.aggregate("parts", F.lit(0.0), lambda a, x: a + (x["zeros"] + x["ones"]))
    predicted = parts.select(row, (2 * ones > every).cast("double").alias(mean.getPredictionCol()))
    return stored.join(predicted, row).drop(row)


class StoredForest(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """A forest as several of Spark's, one folder each; never more than one of them is on the driver.

    Adds the class with the larger sum of all trees' shares, ties going to class 0. A transform runs
    at once, folder after folder, and stores its rows.
    """

    def __init__(self, paths: list[str] | None = None, features: str = "features", prediction: str = "prediction"):
        super().__init__()
        self.paths = paths or []
        self._set(featuresCol=features, predictionCol=prediction)

    def _transform(self, df: DataFrame) -> DataFrame:
        features, row = self.getFeaturesCol(), f"row_{uuid.uuid4().hex}"  # clashes with no column
        stored = materialise(df.withColumn(row, F.monotonically_increasing_id()))
        votes = None
        for at, path in enumerate(self.paths):
            model = RandomForestClassificationModel.load(path).setFeaturesCol(features)
            model = model.setRawPredictionCol("votes").setProbabilityCol("").setPredictionCol("")
            cast = model.transform(stored.select(row, F.col(features).alias(features))).withColumn("votes", vector_to_array("votes"))
            part = F.struct(F.lit(at).alias("at"), F.get("votes", F.lit(0)).alias("zeros"), F.get("votes", F.lit(1)).alias("ones"))
            cast = materialise(cast.select(F.col(row), part.alias("part")))
            votes = cast if votes is None else votes.unionByName(cast)
        parts = votes.groupBy(row).agg(F.sort_array(F.collect_list("part")).alias("parts"))  # one for each folder
        zeros, ones = (F.aggregate(F.col(f"parts.{c}"), F.lit(0.0), lambda a, x: a + x) for c in ("zeros", "ones"))
        predicted = parts.select(row, (ones > zeros).cast("double").alias(self.getPredictionCol()))
        return stored.join(predicted, row).drop(row)

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, forest: StoredForest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.forest, path, self.sparkSession, {"parts": len(self.forest.paths)})
        for at, part in enumerate(self.forest.paths):
            RandomForestClassificationModel.load(part).write().overwrite().save(f"{path}/parts/{at}")


class _ForestReader(MLReader):
    def load(self, path: str) -> StoredForest:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        forest = StoredForest([f"{path}/parts/{at}" for at in range(metadata["parts"])])
        forest._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(forest, metadata)
        return forest


def grow_stored(data: DataFrame, grower: RandomForestClassifier, together: int) -> StoredForest:
    """As many trees as `grower` asks for, `together` at a time, each lot stored before the next is grown."""
    paths, trees = [], grower.getNumTrees()
    for at in range(0, trees, together):
        lot = {grower.numTrees: min(together, trees - at), grower.seed: grower.getSeed() + at}
        if trees > 1:  # a lot of one tree is one of a forest, with its bag and its choice of features
            lot |= {grower.featureSubsetStrategy: "sqrt", grower.bootstrap: True}
        paths.append(fresh_path(data.sparkSession, "trees"))
        grower.copy(lot).fit(data).write().save(paths[-1])
    return StoredForest(paths, grower.getFeaturesCol(), grower.getPredictionCol())


@dataclass
class BaggedForest:
    """`model` adds `prediction`; `votes` has the row id, the label, `trees`, the number of
    trees that the row was kept out of, and `share`, the mean of their shares of class 1."""

    model: PipelineModel
    votes: DataFrame
    oob_score: float | None


def bag_weight(row_id: str | Column, bag: int, seed: int) -> Column:
    """How often the row is in the bag: a Poisson number of mean 1."""
    key = F.col(row_id) if isinstance(row_id, str) else row_id
    u = F.pmod(F.xxhash64(key, F.lit(seed), F.lit(bag)), F.lit(_UNIT)) / float(_UNIT)
    # Its distribution function, up to where doubles end.
    shares = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(17)]
    number = F.lit(float(len(shares)))
    for k in reversed(range(len(shares))):
        number = F.when(u < shares[k], float(k)).otherwise(number)
    return number


def fit_bagged_forest(
    df: DataFrame,
    grower: RandomForestClassifier,
    row_id: str,
    weight: Column | None = None,
    trees_per_bag: int = TREES_PER_BAG,
    seed: int = fixed.SEED,
) -> BaggedForest:
    """As many trees as `grower` asks for, `trees_per_bag` to a bag, on its label and features.

    Rows with the same id are in the same bags. A row that is in every bag has no
    out-of-bag answer; if all are, the score is None. Ties go to class 0.
    """
    label, features, trees = grower.getLabelCol(), grower.getFeaturesCol(), grower.getNumTrees()
    base = (F.lit(1.0) if weight is None else weight).alias("_base")
    data = materialise(df.select(row_id, F.col(label).cast("double").alias(label), features, base, F.monotonically_increasing_id().alias("_row")))
    tasks = max(1, math.ceil(data.count() / TASK_ROWS))
    sizes = [min(trees_per_bag, trees - at) for at in range(0, trees, trees_per_bag)]

    @inheritable_thread_target(df.sparkSession)
    def grow(bag: int):
        count = bag_weight(row_id, bag, seed)
        rows = data.select(label, features, count.alias("_count"), (count * F.col("_base")).alias("_weight")).where("_count > 0")
        # With node ids kept by the rows, trees aren't sent to the tasks of every level.
        change = {grower.numTrees: sizes[bag], grower.bootstrap: False, grower.seed: seed + bag, grower.weightCol: "_weight", grower.cacheNodeIds: True}
        if trees > 1:  # what Spark's forest does by itself, which a single tree of it does not
            change[grower.featureSubsetStrategy] = "sqrt"
        model = grower.copy(change).fit(rows.coalesce(tasks))
        model = model.setRawPredictionCol(f"_votes{bag}").setProbabilityCol("").setPredictionCol("")
        left_out = data.where(bag_weight(row_id, bag, seed) == 0).select("_row", features).coalesce(tasks)
        cast = model.transform(left_out).select("_row", _share(f"_votes{bag}").alias("ones"))
        return model, materialise(cast.withColumn("bag", F.lit(bag)))

    with ThreadPoolExecutor(TOGETHER) as pool:
        models, cast = zip(*pool.map(grow, range(len(sizes))), strict=True)
    names = [f"_votes{bag}" for bag in range(len(sizes))]
    n = sum(F.when(F.array_contains("parts.bag", bag), size).otherwise(0) for bag, size in enumerate(sizes))
    ones = F.aggregate("parts.ones", F.lit(0.0), lambda a, x: a + x)
    every = reduce(DataFrame.unionByName, cast)
    parts = every.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("bag", "ones"))).alias("parts"))  # one for each bag
    answers = parts.select("_row", n.alias("trees"), F.try_divide(ones, n).alias("share"))
    voters = data.select("_row", row_id, F.col(label).cast("int").alias(label)).join(answers, "_row", "left")
    votes = materialise(voters.select(row_id, label, F.coalesce("trees", F.lit(0)).alias("trees"), "share"))
    return BaggedForest(PipelineModel([*models, VoteMean(inputCols=names)]), votes, out_of_bag_score(votes, label))


def out_of_bag_score(votes: DataFrame, label: str) -> float | None:
    """The share of right answers among rows that have one."""
    right = ((F.col("share") > 0.5).cast("int") == F.col(label)).cast("double")
    return votes.where("trees > 0").agg(F.avg(right)).first()[0]
