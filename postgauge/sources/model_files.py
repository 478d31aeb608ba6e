"""Saved models and what is known about them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.pipeline import PipelineModelWriter, PipelineSharedReadWrite
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession

METADATA = "model_type string, label_type string, median_threshold double, training_date string"


TOGETHER = 8  # stages written at a time


class _SideBySide(PipelineModelWriter):
    """Writes what `model.write()` does, several stages at a time: each bag of a forest is one task."""

    def saveImpl(self, path: str) -> None:
        stages, spark = self.instance.stages, self.sparkSession
        PipelineSharedReadWrite.validateStages(stages)
        uids = [stage.uid for stage in stages]

        @inheritable_thread_target(spark)
        def save(at: int) -> None:
            writer = _SideBySide(stages[at]) if isinstance(stages[at], PipelineModel) else stages[at].write()
            writer.session(spark).save(PipelineSharedReadWrite.getStagePath(uids[at], at, len(uids), f"{path}/stages"))

        DefaultParamsWriter.saveMetadata(self.instance, path, spark, paramMap={"stageUids": uids, "language": "Python"})
        with ThreadPoolExecutor(TOGETHER) as pool:
            list(pool.map(save, range(len(uids))))


def save_model(model: PipelineModel, path: str) -> None:
    """Features and classifier together, as one pipeline."""
    _SideBySide(model).overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_model_metadata(spark: SparkSession, path: str, model_type: str, median_threshold: float | None) -> None:
    label_type = "quality_based" if median_threshold is None else "score_based"
    row = (model_type, label_type, median_threshold, datetime.now().isoformat())
    spark.createDataFrame([row], METADATA).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def load_model_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).json(path)
