"""Word-vector means and their reduction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from postgauge.functions import text as T
from postgauge.operators import lookup
from postgauge.operators.lookup import lookup_words

# Numbers a broadcast vector table may hold: 256 MiB of doubles.
BROADCAST_NUMBERS = 32 * 1024 * 1024
# Numbers of a vector table that every Python worker may hold: 128 MiB of doubles.
MATRIX_NUMBERS = 16 * 1024 * 1024
# Numbers of word vectors that a product gathers at once: 8 MiB of doubles.
GATHERED = 1024 * 1024
# Texts whose means a task holds at once.
MEAN_ROWS = 1024


def word_vector_lookup(
    df: DataFrame, text: Column, row_id: str, vectors: DataFrame, dims: int
) -> DataFrame:
    """One row per known token (or distinct token, with its count in `uses`)."""
    words = df.select(row_id, F.explode(T.word_tokens(text)).alias("word"))
    return lookup_words(words, vectors.select("word", "vector"), "inner", BROADCAST_NUMBERS // dims)


def vector_width(vectors: DataFrame) -> int:
    row = vectors.select(F.size("vector").alias("d")).first()
    if row is None:
        raise ValueError("the word-vector table is empty")
    return row["d"]


def word_matrix(vectors: DataFrame, dims: int) -> tuple[dict[str, int], np.ndarray]:
    """Rows of words, and their vectors as a matrix; for tables that are counted small.

    Words without a vector are unknown; missing components count as zero.
    """
    whole = F.transform("vector", lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    table = vectors.where("word IS NOT NULL AND vector IS NOT NULL").select("word", whole.alias("vector")).toArrow()
    numbers = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return {w: k for k, w in enumerate(table["word"].to_pylist())}, numbers.reshape(-1, dims)


def batch_means(tokens: pa.Array, rows: dict[str, int], matrix: np.ndarray) -> np.ndarray:
    """Means of the known tokens of every list: counts of words by text times the word matrix.

    The counts are kept as sorted pairs of text and word; at most `GATHERED` numbers of their
    vectors are at hand at once.
    """
    n, dims = len(tokens), matrix.shape[1]
    words = tokens.flatten().dictionary_encode()
    place = np.array([rows.get(w, -1) for w in words.dictionary.to_pylist()], dtype=np.int64)
    lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    texts = np.repeat(np.arange(n), lengths)
    used = place[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
    texts, used = texts[used >= 0], used[used >= 0]
    pairs, counts = np.unique(texts * len(matrix) + used, return_counts=True)
    sums = np.zeros((n, dims))
    step = max(1, GATHERED // max(1, dims))
    for at in range(0, len(pairs), step):
        of, word = np.divmod(pairs[at : at + step], len(matrix))
        weighed = matrix[word] * counts[at : at + step, None]
        begins = np.flatnonzero(np.diff(of, prepend=-1))
        sums[of[begins]] += np.add.reduceat(weighed, begins, axis=0)
    return sums / np.maximum(1, np.bincount(texts, minlength=n))[:, None]


def mean_word_vector(
    df: DataFrame, text: Column, row_id: str, vectors: DataFrame, dims: int | None = None
) -> DataFrame:
    """Mean vector of the known tokens per text; without any, zeros. Row ids don't repeat.

    Texts are cut into tokens where they are read, and a batch of them meets the word matrix in one
    sparse product: nothing is exploded and nothing moves, however wide the vectors are. A table
    of more than `MATRIX_NUMBERS` is looked up by joins and summed by row id.
    """
    dims = dims or vector_width(vectors)
    if not dims or not lookup.fits(vectors, MATRIX_NUMBERS // dims):
        return _mean_by_joins(df, text, row_id, vectors, dims)
    shared = df.sparkSession.sparkContext.broadcast(word_matrix(vectors, dims))
    read = df.select(row_id, T.word_tokens(text).alias("tokens"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, matrix = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, MEAN_ROWS):
                batch = whole.slice(at, MEAN_ROWS)
                means = batch_means(batch.column(1), rows, matrix)
                offsets = pa.array(np.arange(len(means) + 1, dtype=np.int32) * dims)
                vector = pa.ListArray.from_arrays(offsets, pa.array(means.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), vector], [row_id, "vector"])

    return read.mapInArrow(multiply, StructType([read.schema[row_id]]).add("vector", ArrayType(DoubleType())))


def _mean_by_joins(df: DataFrame, text: Column, row_id: str, vectors: DataFrame, dims: int) -> DataFrame:
    """The same means for any number of words: one plain sum per dimension keeps the aggregate
    in fixed-width buffers, so a text's tokens collapse to one row before the only shuffle. The
    left lookup keeps texts without a known token, so no join back is needed.
    """
    words = df.select(row_id, T.word_tokens(text).alias("words")).select(row_id, F.explode_outer("words").alias("word"))
    found = lookup_words(words, vectors.select("word", "vector"), "left", BROADCAST_NUMBERS // dims)
    # One SQL string per list of columns: building hundreds of column objects takes seconds.
    sums = found.groupBy(row_id).agg(
        F.expr("sum(CASE WHEN vector IS NOT NULL THEN uses END) AS known"),
        *[F.expr(f"sum(vector[{i}] * uses) AS v{i}") for i in range(dims)],
    )
    means = ", ".join(f"coalesce(v{i} / known, 0.0D)" for i in range(dims))
    return sums.select(row_id, F.expr(f"array({means}) AS vector"))


def fit_svd(df: DataFrame, vector: str, components: int) -> np.ndarray:
    """Right singular vectors of the uncentred rows, one column per component.

    The d x d product of the rows with themselves is summed in the JVM in one pass;
    only that small matrix reaches the driver.
    """
    rows = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(F.col(vector)).alias("v")), "v")
    gram = RowMatrix(rows).computeGramianMatrix().toArray()
    values, basis = np.linalg.eigh((gram + gram.T) / 2)
    order = np.argsort(values)[::-1][: min(components, gram.shape[0])]
    basis = basis[:, order]
    # Signs are free; make the largest loading positive.
    signs = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])
    return basis * np.where(signs == 0, 1.0, signs)


def project(vector: Column, basis: np.ndarray) -> Column:
    """Rows times basis, as arrays."""
    matrix = np.ascontiguousarray(basis, dtype=np.float64)

    @F.pandas_udf(ArrayType(DoubleType()))
    def multiply(s: pd.Series) -> pd.Series:
        if s.empty:
            return pd.Series([], dtype=object)
        return pd.Series(list(np.stack(s.to_numpy()) @ matrix))

    # Called so that the optimiser never evaluates it twice.
    return multiply.asNondeterministic()(vector)
