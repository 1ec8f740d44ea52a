"""Text to vectors: the plug-in point for models, and a built-in hashed encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F, types as T

from negsift.functions.vectors import cut_vector, hashed_counts, hashed_tokens
from negsift.operators.spread import spread_small
from negsift.schema import KEYS

VECTOR = T.ArrayType(T.FloatType())


def hashed_encoder(dim: int = 256, max_tokens: int = 0) -> Callable[[DataFrame, str], DataFrame]:
    """Hashed bag of words. ``max_tokens > 0`` is the token limit of the model."""

    def encode(rows: DataFrame, text: str) -> DataFrame:
        return spread_small(rows).withColumn("embedding", hashed_counts(F.col(text), dim, max_tokens))

    return encode


def model_encoder(make_predict: Callable, batch_size: int = 32) -> Callable[[DataFrame, str], DataFrame]:
    """Any batch model. ``make_predict`` loads it, once per Python worker, and
    returns a function from an array of texts to an array of vectors."""

    def encode(rows: DataFrame, text: str) -> DataFrame:
        predict = predict_batch_udf(make_predict, return_type=VECTOR, batch_size=batch_size)
        return spread_small(rows).withColumn("embedding", predict(F.col(text)))

    return encode


def budget_batches(sizes: np.ndarray, budget: int) -> Iterator[slice]:
    """Runs of ascending ``sizes`` whose longest times their number is at most ``budget``; one text at least."""
    at = 0
    while at < len(sizes):
        to = at + 1
        while to < len(sizes) and sizes[to] * (to + 1 - at) <= budget:
            to += 1
        yield slice(at, to)
        at = to


def budget_encoder(
    make_predict: Callable, budget: int = 16_384, length: Callable[[str], int] = len
) -> Callable[[DataFrame, str], DataFrame]:
    """Any batch model, in batches of texts of similar length.

    A model pads a batch to its longest text. So the texts of an Arrow batch are sorted by ``length``, cut into
    batches of at most ``budget`` (the longest times their number), and their vectors put back in
    the order of the rows. ``make_predict`` is as for :func:`model_encoder`; a null text counts as empty.
    """

    def encode(rows: DataFrame, text: str) -> DataFrame:
        @F.pandas_udf(VECTOR)
        def predict(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = make_predict()
            for texts in series:
                values = texts.fillna("").to_numpy(object)
                sizes = np.array([length(value) for value in values], np.int64)
                order, out = np.argsort(sizes, kind="stable"), [None] * len(values)
                for run in budget_batches(sizes[order], budget):
                    for row, vector in zip(order[run], model(values[order[run]])):
                        out[row] = vector
                yield pd.Series(out)

        return spread_small(rows).withColumn("embedding", predict(F.col(text)))

    return encode


def vector_column(name: str) -> Callable[[DataFrame, str], DataFrame]:
    """Vectors that the table already holds."""
    return lambda rows, text: rows.withColumn("embedding", F.col(name).cast(VECTOR))


def mode_of(text: str) -> str:
    """Which side of the search a text column is."""
    return "query" if text == "query" else "document"


def hashed_token_encoder(max_tokens: dict[str, int] | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """``tokens``: a unit vector of 16 numbers per word, taken from the word's MD5.

    ``max_tokens`` is the model's limit by mode, query or document; a word of a text
    counts once, where it first stands. A null text has no tokens.
    """
    limits = max_tokens or {}

    def encode(rows: DataFrame, text: str) -> DataFrame:
        return spread_small(rows).withColumn("tokens", hashed_tokens(F.col(text), limits.get(mode_of(text), 0)))

    return encode


def model_token_encoder(make_predict: Callable, batch_size: int = 32) -> Callable[[DataFrame, str], DataFrame]:
    """Any late-interaction model. ``make_predict(mode)`` loads it for queries or for
    documents, once per task, and returns a function from a list of texts to a list of matrices,
    a row per token."""

    def encode(rows: DataFrame, text: str) -> DataFrame:
        mode = mode_of(text)

        @F.pandas_udf(T.ArrayType(VECTOR))
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = make_predict(mode)
            for batch in batches:
                texts = batch.fillna("").tolist()
                found = [matrix for at in range(0, len(texts), batch_size) for matrix in model(texts[at : at + batch_size])]
                yield pd.Series([[list(map(float, v)) for v in matrix] for matrix in found])

        return spread_small(rows).withColumn("tokens", predict(F.col(text)))

    return encode


def token_matrix(rows: DataFrame, parts: int, width: int, vector: str = "embedding") -> DataFrame:
    """Adds ``tokens``, one vector per consecutive piece of a vector column."""
    return rows.withColumn("tokens", cut_vector(F.col(vector), parts, width))


def token_vectors(rows: DataFrame, id_col: str) -> DataFrame:
    """Long form of a ``tokens`` column: one row per token vector."""
    return rows.select(*KEYS, id_col, F.posexplode("tokens").alias("tok", "v"))
