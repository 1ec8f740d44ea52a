"""Product codes after a learned rotation, and exact scores of the best hits.

Codes cut a vector into sub-vectors, which loses most where its numbers vary together. A rotation of
all vectors keeps every product and distance, and can spread what varies over the sub-vectors. It is
found by turns: code all residuals under the present rotation; then take the
rotation that brings the residuals closest to what their codes say, from the singular vectors of one
(dimension x dimension) sum; and move each code to the mean of what it stands for. A turn is one pass over the
corpus, for all bundles together; only sums whose size is a parameter come to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from negsift.operators.cells import Matrices, as_indexed, ivfpq_topk, residuals, train_cells, train_rotation, with_cell, with_codes
from negsift.operators.graph import pair_score
from negsift.operators.scorers import matrix
from negsift.operators.topk import best
from negsift.schema import KEYS
from negsift.session import stored

TURNS = 8


def rotated(rows: DataFrame, rotation: Matrices, metric: str = "ip") -> DataFrame:
    """``embedding`` (of unit length for cosine) in the directions of its bundle's rotation."""
    shared = rows.sparkSession.sparkContext.broadcast(rotation)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def turn(dataset: pa.Array, lang: pa.Array, vectors: pa.Array) -> pa.Array:
        block = as_indexed(matrix(pa.chunked_array([vectors])), metric)
        out = np.array(block)
        for key, at in pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices.items():
            if key in shared.value:
                out[at] = block[at] @ shared.value[key]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))

    # So marked, it is computed once for all that read it.
    return rows.withColumn("embedding", turn.asNondeterministic()("dataset", "lang", "embedding"))


def turned(centroids: Matrices, rotation: Matrices) -> Matrices:
    return {key: block @ rotation[key] for key, block in centroids.items()}


def build_rotated(
    corpus: DataFrame, nlist: int = 100, m: int = 8, metric: str = "cosine", seed: int = 42, turns: int = TURNS, rotate: bool = True
) -> tuple[DataFrame, Matrices, dict, Matrices]:
    """Coded corpus, rotated centroids, codebooks and the rotation."""
    centroids = train_cells(corpus, nlist, metric, seed)
    rest = stored(residuals(with_cell(corpus.select(*KEYS, "document_id", "embedding"), centroids, metric), centroids, metric), "residuals")
    rotation, books = train_rotation(rest, m, seed, turns, rotate)
    return with_codes(rotated(rest, rotation), books), turned(centroids, rotation), books, rotation


def reranked(hits: DataFrame, queries: DataFrame, corpus: DataFrame, k: int, metric: str) -> DataFrame:
    """``hits`` with the exact score of each pair, and the best ``k`` of them."""
    of_query, of_document = [*KEYS, "query_id"], [*KEYS, "document_id"]
    pairs = hits.select(*KEYS, "query_id", "document_id")
    pairs = pairs.join(corpus.select(*of_document, F.col("embedding").alias("_d")), of_document)
    pairs = pairs.join(queries.select(*of_query, F.col("embedding").alias("_q")), of_query)
    scored = pairs.select(*KEYS, "query_id", "document_id", pair_score(metric)("_q", "_d").alias("score"))
    return best(scored, k, metric == "l2")


def rotated_topk(
    queries: DataFrame, corpus: DataFrame, index: tuple, k: int, nprobe: int = 10, metric: str = "cosine", keep: int | None = None, **physical
) -> DataFrame:
    """The best ``keep`` (``4 k``) by codes of the rotated vectors, ranked by exact score."""
    coded, centroids, books, rotation = index
    spun = rotated(queries.select(*KEYS, "query_id", "embedding"), rotation, metric)
    found = ivfpq_topk(spun, coded, centroids, books, keep or 4 * k, nprobe, metric, **physical)
    return reranked(stored(found, "coded-hits"), queries, corpus, k, metric)
