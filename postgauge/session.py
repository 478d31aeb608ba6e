"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postgauge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session that names none gets a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path for a written table inside the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Store the rows in the shared folder and go on from there.

    Lost executors then cost a reread, not a recomputation, and what follows reads
    only the columns it needs.
    """
    path = fresh_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core on a table that arrives in too few pieces.

    A table split into at least one partition per core, as any large one is, stays
    as it was read. Spreading by the row id lets a later grouping by it reuse the shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
