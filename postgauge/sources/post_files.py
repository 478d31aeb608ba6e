"""Reading and writing post collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.functions import fixed
from postgauge.functions.posts import group_key
from postgauge.operators.splitting import first_rows
from postgauge.sources.csv_records import csv_records

# Attributes of a post row, with the type each has once read.
POST_TYPES = {
    "Id": "bigint",
    "PostTypeId": "int",
    "ParentId": "bigint",
    "Title": "string",
    "Body": "string",
    "Tags": "string",
    "Score": "int",
    "OwnerUserId": "string",
    "AcceptedAnswerId": "bigint",
    "ClosedDate": "string",
    "CreationDate": "string",
    "AnswerCount": "bigint",
    "CommentCount": "bigint",
    "ViewCount": "bigint",
    "FavoriteCount": "bigint",
}


def _string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def typed_posts(raw: DataFrame, group_column: str = "OwnerUserId") -> DataFrame:
    """Cast known columns; a value that does not fit its type becomes null.

    Whole numbers may be written with a decimal point, as in `7.0`.
    """

    def typed(c: str) -> Column:
        kind = POST_TYPES.get(c, "string")
        if kind in ("int", "bigint"):
            number = F.col(c).try_cast("decimal(38,6)")
            return F.when(number == F.floor(number), number).try_cast(kind).alias(c)
        return F.col(c) if kind == "string" else F.col(c).try_cast(kind).alias(c)

    columns = [typed(c) for c in raw.columns]
    out = raw.select(*columns)
    return out.withColumn(group_column, group_key(group_column)) if group_column in raw.columns else out


# The text of a row element after its name, up to the end of its tag.
ROW_TAG = r"""^((?:[^"'<>]++|"[^"<]*+"|'[^'<]*+')*+)>"""
ATTRIBUTE = r"""([^\s"'<>/=]+)\s*=\s*(?:"[^"]*"|'[^']*')"""


def row_elements(spark: SparkSession, path: str) -> DataFrame:
    """One record for each `<row .../>` in the files, as `xml`, wherever lines begin and end.

    Text is cut before every row, so Spark splits one large file over many tasks. A row whose
    tag can't be read stays as it is, for the parser to refuse; what stands before the first
    row of a file (markup or blanks) is no row.
    """
    records = spark.read.option("lineSep", "<row").text(path)
    # "<rows" and the like begin another element; a file begins with markup.
    records = records.where(F.col("value").rlike(r"^[\s/>]") & ~F.col("value").rlike(r"^\s*(<|$)"))
    attributes = F.regexp_extract("value", ROW_TAG, 1)
    element = F.concat(F.lit("<row"), F.rtrim(F.rtrim(attributes), F.lit("/")), F.lit("/>"))
    return records.select(F.when(F.col("value").rlike(ROW_TAG), element).otherwise(F.concat(F.lit("<row"), "value")).alias("xml"))


def attribute_names(rows: DataFrame) -> list[str]:
    """Attributes that occur in any row, sorted: a pass over the files that brings names only."""
    names = F.regexp_extract_all("xml", F.lit(ATTRIBUTE), F.lit(1))
    return sorted(r["name"] for r in rows.select(F.explode(F.array_distinct(names)).alias("name")).distinct().collect())


def read_posts_xml(
    spark: SparkSession, path: str, columns: list[str] | None = None, group_column: str = "OwnerUserId"
) -> DataFrame:
    """Posts from files of `<row .../>` elements; attributes become columns.

    Every row is kept, one without attributes too, and a row that is no XML fails the job.
    Without `columns` all known attributes are read and all others that occur, which costs a
    pass to find their names; a column that no row has is null.
    """
    rows = row_elements(spark, path)
    if columns is None:
        columns = [*POST_TYPES, *(n for n in attribute_names(rows) if n not in POST_TYPES)]
    options = {"rowTag": "row", "attributePrefix": "", "ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}
    post = F.from_xml("xml", _string_schema(columns), options).alias("post")
    return typed_posts(rows.select(post).select(*[F.col("post").getField(c).alias(c) for c in columns]), group_column)


def write_posts_xml(df: DataFrame, path: str) -> None:
    (
        df.select(*[F.col(c).cast("string").alias(f"_{c}") for c in df.columns])
        .write.format("xml")
        .option("rowTag", "row")
        .option("rootTag", "posts")
        .save(path)
    )


def limit_posts(df: DataFrame, n: int = fixed.ROW_CAP) -> DataFrame:
    """The development cap: the first n posts by id."""
    return first_rows(df, n, "Id", F.col("Id"))


CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
# Keep spaces and line ends inside quoted text as they are.
CSV_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_posts_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, questions_only: bool = False, split: bool = True
) -> DataFrame:
    """Posts from CSV with quoted line breaks. Empty text reads as null.

    One large file is read by many tasks: see `csv_records`. Files with quote marks in unquoted
    fields need `split=False`, which reads a file in one task.
    """
    schema = _string_schema(columns or list(POST_TYPES))
    if split:
        fields = F.from_csv("record", ", ".join(f"`{f.name}` string" for f in schema), CSV_OPTIONS | CSV_SPACES)
        raw = csv_records(spark, path).select(fields.alias("post")).select("post.*")
    else:
        raw = spark.read.options(**CSV_OPTIONS, **CSV_SPACES).schema(schema).csv(path)
    out = typed_posts(raw)
    return out.where(F.col("PostTypeId") == 1) if questions_only else out


def write_posts_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS, **CSV_SPACES).csv(path)


def write_posts(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The stage format: typed Parquet."""
    df.write.mode(mode).parquet(path)
