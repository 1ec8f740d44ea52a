"""Compressed token vectors for late interaction, and the search that opens few of them.

A document keeps, per token, the number of its closest centroid and what is left of the vector, ``bits``
bits per dimension: the place among quantile cutoffs of that dimension, packed. A token of 128
numbers takes 4 + 32 bytes at 2 bits instead of 512. Read back, a token is its centroid
plus the middle of each place.

Search in stages, each over fewer documents: centroids that no token of the query comes near
(``least``) are not looked into; documents in the others are scored by centroids alone; the residuals
of the best ``keep`` are opened and scored. Scores are those of the vectors as read back.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from negsift.operators.cells import Matrices, train_cells
from negsift.operators.late import _each_token, exact_scores, most_cells, shared_topk, token_codes, token_probes
from negsift.operators.scorers import CentroidMaxSim, matrix
from negsift.operators.topk import BROADCAST_BYTES, best
from negsift.schema import KEYS
from negsift.session import stored

#: Quantiles are those of a digest with a relative error of one in this.
ACCURACY = 10_000


class Codec(NamedTuple):
    """Per bundle: ``cutoffs`` (dimension, 2^bits - 1) and ``middles`` (dimension, 2^bits)."""

    bits: int
    centroids: Matrices
    cutoffs: Matrices
    middles: Matrices


class Late(NamedTuple):
    documents: DataFrame  # dataset, lang, document_id, codes, packed
    codec: Codec


def token_residuals(tokens: DataFrame, centroids: Matrices) -> DataFrame:
    """``embedding`` (a token a row) less its closest centroid by inner product."""
    shared = tokens.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def rest(dataset: pa.Array, lang: pa.Array, vectors: pa.Array) -> pa.Array:
        block = matrix(pa.chunked_array([vectors]))
        out = np.zeros(block.shape)
        for key, at in pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices.items():
            centers = shared.value[key]
            out[at] = block[at] - centers[(block[at] @ centers.T).argmax(1)]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))

    return tokens.withColumn("embedding", rest("dataset", "lang", "embedding"))


def train_codec(corpus: DataFrame, nlist: int = 100, bits: int = 2, seed: int = 42, centroids: Matrices | None = None) -> Codec:
    """Centroids of all tokens, and quantiles of each dimension's residuals, found in one aggregation."""
    if bits not in (1, 2, 4, 8):
        raise ValueError(f"{bits} bits do not fill bytes")
    tokens = _each_token(corpus, "document_id")
    centroids = train_cells(tokens, nlist, "ip", seed) if centroids is None else centroids
    places = 1 << bits
    shares = [i / places for i in range(1, places)] + [(i + 0.5) / places for i in range(places)]
    dim = max((v.shape[1] for v in centroids.values()), default=0)
    cut = [F.percentile_approx(F.col("embedding")[i], shares, ACCURACY).alias(f"_{i}") for i in range(dim)]
    cutoffs, middles = {}, {}
    for row in token_residuals(tokens, centroids).groupBy(*KEYS).agg(*cut).collect():  # a row per bundle
        found = np.array([row[f"_{i}"] for i in range(dim)])
        cutoffs[row["dataset"], row["lang"]], middles[row["dataset"], row["lang"]] = found[:, : places - 1], found[:, places - 1 :]
    return Codec(bits, centroids, cutoffs, middles)


def _apart(corpus: DataFrame, codec: Codec) -> Column:
    """Mean distance of a document's tokens to their centroids."""
    shared = corpus.sparkSession.sparkContext.broadcast(codec.centroids)

    @F.arrow_udf(T.DoubleType())
    def far(dataset: pa.Array, lang: pa.Array, texts: pa.Array, codes: pa.Array) -> pa.Array:
        out = []
        for key, tokens, cells in zip(zip(dataset.to_pylist(), lang.to_pylist()), texts, codes.to_pylist()):
            block = matrix(pa.chunked_array([tokens.values])) - shared.value[key][np.array(cells)] if cells else np.zeros((1, 1))
            out.append(float(np.linalg.norm(block, axis=1).mean()))
        return pa.array(out, pa.float64())

    return far("dataset", "lang", "tokens", "codes")


def compress(corpus: DataFrame, codec: Codec, far: bool = False) -> Late:
    """Documents as ``codes`` and ``packed``: residuals of all tokens in order, ``bits`` a number.

    With ``far``, also the mean distance of their tokens to their centroids.
    """
    shared = corpus.sparkSession.sparkContext.broadcast(codec)

    @F.arrow_udf(T.BinaryType())
    def pack(dataset: pa.Array, lang: pa.Array, texts: pa.Array, codes: pa.Array) -> pa.Array:
        known, out = shared.value, []
        for key, tokens, cells in zip(zip(dataset.to_pylist(), lang.to_pylist()), texts, codes):
            if not tokens.is_valid or not len(tokens):
                out.append(b"")
                continue
            block = matrix(pa.chunked_array([tokens.values]))
            rest = block - known.centroids[key][np.array(cells.as_py())]
            place = (rest[:, :, None] > known.cutoffs[key][None]).sum(2).astype(np.uint8)
            bits = np.unpackbits(place[:, :, None], axis=2)[:, :, 8 - known.bits :]
            out.append(np.packbits(bits.reshape(len(block), -1), axis=1).tobytes())
        return pa.array(out, pa.binary())

    coded = corpus.select(*KEYS, "document_id", "tokens", token_codes(corpus, codec.centroids).alias("codes"))
    packed = pack("dataset", "lang", "tokens", "codes").alias("packed")
    more = [_apart(corpus, codec).alias("far")] if far else []
    return Late(coded.select(*KEYS, "document_id", "codes", packed, *more), codec)


def opened(rows: DataFrame, codec: Codec) -> Column:
    """Token vectors of ``codes`` and ``packed``."""
    shared = rows.sparkSession.sparkContext.broadcast(codec)

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def unpack(dataset: pa.Array, lang: pa.Array, codes: pa.Array, packed: pa.Array) -> pa.Array:
        known, blocks, counts = shared.value, [], []
        for key, cells, data in zip(zip(dataset.to_pylist(), lang.to_pylist()), codes.to_pylist(), packed.to_pylist()):
            counts.append(len(cells or ()))
            if not cells:
                continue
            centers, middles = known.centroids[key], known.middles[key]
            dim = centers.shape[1]
            bits = np.unpackbits(np.frombuffer(data, np.uint8).reshape(len(cells), -1), axis=1)[:, : dim * known.bits]
            place = bits.reshape(len(cells), dim, known.bits) @ (1 << np.arange(known.bits)[::-1])
            blocks.append(centers[np.array(cells)] + np.take_along_axis(middles[None], place[:, :, None], axis=2)[:, :, 0])
        flat = np.concatenate([b.ravel() for b in blocks]) if blocks else np.zeros(0)
        widths = np.concatenate([np.full(len(b), b.shape[1]) for b in blocks]) if blocks else np.zeros(0, np.int64)
        tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)), pa.array(flat))
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]).astype(np.int32)), tokens)

    return unpack("dataset", "lang", "codes", "packed")


def residual_topk(
    queries: DataFrame, late: Late, k: int, nprobe: int = 2, keep: int | None = None, least: float | None = None, **physical
) -> DataFrame:
    """Best ``k`` documents by the tokens read back, of the ``keep`` (``max(4 k, 256)``) best by centroids."""
    codec = late.codec
    queries = queries.filter(F.size("tokens") > 0)
    probe = stored(token_probes(queries, codec.centroids, nprobe, least), "probes")
    celled = late.documents.withColumn("cells", F.array_distinct("codes")).withColumn("cell", F.explode("cells"))
    scorer = CentroidMaxSim(queries.sparkSession.sparkContext.broadcast(codec.centroids))
    found = shared_topk(probe, celled, keep or max(4 * k, 256), scorer, most_cells(codec.centroids), **physical)
    candidates = stored(found.select(*KEYS, "query_id", "document_id"), "candidates")
    limit = physical.get("broadcast_bytes", BROADCAST_BYTES)
    return best(exact_scores(candidates, queries, late.documents, limit, opened(late.documents, codec)), k)
