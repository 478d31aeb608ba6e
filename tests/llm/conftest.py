import duckdb
import public_tokenizers
import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def rows(spark: SparkSession, data):
    """Rows of a test table as dictionaries, read without Spark."""

    def load(name: str, folder: str = data) -> list[dict]:
        found = duckdb.connect().execute(f"select * from '{folder}/{name}.parquet'")
        names = [c[0] for c in found.description]
        return [dict(zip(names, r, strict=True)) for r in found.fetchall()]

    return load


ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "same words here again and again and again",
    "same words here again and again and again",
    "Ünïcode ẞtraße Σίσυφος ΣΑΣ naïve é ́x 日本語 \U0001f600 ퟿",
    "it's we'll 'S a'b 12345 <|endoftext|> <|startoftext|>x <unk>",
    "tab\tnbsp line sep\x1cfile\x1fend\x00zero\r\nwin",
    "x" * 5000,
    "long words " * 20_000,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Texts of every awkward kind, with a null id, a repeated row and clashing column names."""
    kept = [(k, t, k) for k, t in enumerate(ODD_TEXTS)]
    kept += [(None, "no id at all in this row of words", 1), kept[4]]
    return spark.createDataFrame(kept, "doc_id bigint, text string, row bigint")
