"""Read, clean, label, split and store a post collection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from postgauge.functions import fixed
from postgauge.functions.text import clean_tags, strip_html
from postgauge.operators.labeling import label_distribution, with_quality_label
from postgauge.operators.splitting import group_overlap, split_by_group
from postgauge.sources.post_files import limit_posts, read_posts_xml, write_posts


@dataclass
class Ingested:
    train: DataFrame
    test: DataFrame
    labels: DataFrame


def ingest_posts(
    spark: SparkSession,
    source: str,
    target: str,
    post_type: int | None = None,
    cap: int | None = None,
    group: str = "OwnerUserId",
    train_share: float = fixed.TRAIN_SHARE,
    seed: int = fixed.SEED,
    columns: list[str] | None = None,
) -> Ingested:
    """XML in, `train` and `test` tables out; raises if an author is on both sides.

    Any attribute may be the group. The cleaned posts are stored once and both sides read
    from there; `columns` names the attributes to read and spares the pass that finds them.
    """
    raw = read_posts_xml(spark, source, columns, group_column=group)
    if post_type is not None:
        raw = raw.where(raw.PostTypeId == post_type)
    if cap is not None:
        raw = limit_posts(raw, cap)
    cleaned = raw.withColumn("Body", strip_html("Body")).withColumn("Tags", clean_tags("Tags"))
    write_posts(cleaned, f"{target}/posts")
    posts = spark.read.parquet(f"{target}/posts")
    train, test = split_by_group(posts, group, train_share=train_share, seed=seed)
    write_posts(train, f"{target}/train")
    write_posts(test, f"{target}/test")
    train, test = (spark.read.parquet(f"{target}/{side}") for side in ("train", "test"))
    if not group_overlap(train, test, group).isEmpty():
        raise AssertionError(f"a value of {group} is on both sides of the split")
    return Ingested(train, test, label_distribution(with_quality_label(posts)))
