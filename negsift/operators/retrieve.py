"""Choosing a search: metric, index kind, single vectors or token vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from negsift.operators.balls import balls_topk, build_balls
from negsift.operators.cells import build_codes, ivf_topk, ivfpq_topk, lsh_topk, train_cells, with_cell
from negsift.operators.graph import graph_topk
from negsift.operators.index import search_index
from negsift.operators.late import maxsim_topk, plaid_topk
from negsift.operators.rotation import build_rotated, rotated_topk
from negsift.operators.scorers import Dense
from negsift.operators.topk import FLOOR_SHARE, floor_part, topk
from negsift.schema import KEYS
from negsift.session import stored

# Names of the index kinds and of the retrieval architectures.
METHODS = ("flat", "ivf", "ivfpq", "hnsw")  # and some of our own: "lsh", "ivf_exact", "ivfopq"
ARCHITECTURES = ("single_vector", "late_interaction")


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "cosine",
    method: str = "flat",
    nlist: int = 100,
    nprobe: int = 10,
    m_pq: int = 8,
    hash_tables: int = 8,
    hash_bits: int = 4,
    hash_flips: int = 2,
    graph_degree: int = 16,
    ef_search: int | None = None,
    seed: int = 42,
    **physical,
) -> DataFrame:
    """Top ``k`` documents per query by single-vector similarity.

    Both tables hold ``embedding``. For ``l2`` the score is the squared distance
    and small is near. ``hnsw`` searches a neighbour graph, ``lsh`` hash buckets
    (``hash_*``), ``ivf_exact`` all cells that can hold a hit, ``ivfopq`` codes of rotated
    vectors with exact scores of the best of them.
    """
    scorer = Dense(metric)
    if method == "flat":
        return topk(queries, corpus, k, scorer, ascending=metric == "l2", **physical)
    if method == "ivf":
        centroids = train_cells(corpus, nlist, metric, seed)
        return ivf_topk(queries, with_cell(corpus, centroids, metric), centroids, k, nprobe, metric, **physical)
    if method == "ivfopq":
        index = build_rotated(corpus, nlist, m_pq, metric, seed)
        return rotated_topk(queries, corpus, index, k, nprobe, metric, **physical)
    if method == "ivfpq":
        index = build_codes(corpus, nlist, m_pq, metric, seed)
        return ivfpq_topk(queries, *index, k, nprobe, metric, **physical)
    if method == "ivf_exact":
        return balls_topk(queries, build_balls(corpus, nlist, metric, seed=seed), k, metric, nprobe, **physical)
    if method == "hnsw":
        physical = {c: v for c, v in physical.items() if c == "broadcast_bytes"}
        return graph_topk(queries, corpus, k, metric, graph_degree, ef_search, **physical)
    if method == "lsh":
        return lsh_topk(queries, corpus, k, metric, hash_tables, hash_bits, hash_flips, seed, **physical)
    raise ValueError(f"unknown index method: {method}")


def retrieve(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 200,
    architecture: str = "single_vector",
    encode: Callable[[DataFrame, str], DataFrame] | None = None,
    index: str = "",
    **search,
) -> DataFrame:
    """Hits of text tables: encode ``query`` and ``document``, then search.

    ``encode(rows, text_column)`` adds ``embedding`` (single vectors) or
    ``tokens`` (late interaction). Without it the tables must hold that column.
    ``index`` is the folder of a saved index (:mod:`negsift.operators.index`) to search in place of the corpus,
    whose texts are then not encoded. Any function with this signature can stand in for this one in a job.
    """
    if index:
        queries = stored(_vectors(encode(queries, "query") if encode else queries, "query_id"), "query-vectors")
        return search_index(queries, index, k, **{c: v for c, v in search.items() if c != "metric"})
    if encode is not None:
        whole, late = corpus, architecture == "late_interaction"
        queries, corpus = encode(queries, "query"), encode(corpus, "document")
        # Encoding is the costly step and several passes follow: the vectors of the
        # queries, and of a corpus that gets an index, are written once. Token vectors are many times as large
        # as their texts: an exact search takes them from the texts, as it does single vectors, and those of the floors' part again.
        queries = stored(_vectors(queries, "query_id"), "query-vectors")
        if search.get("method", "flat") != "flat" or late and search.get("pruned", True):
            corpus = stored(_vectors(corpus, "document_id"), "document-vectors", by=KEYS)
        elif late:
            search = {"part": encode(floor_part(whole, search.get("floor_share", FLOOR_SHARE)), "document"), **search}
        search = {"spread": False, **search}  # the encoder has spread a small corpus
    if architecture == "single_vector":
        return knn(queries, corpus, k, **search)
    if architecture == "late_interaction":
        pruned = search.pop("pruned", True)
        return plaid_topk(queries, corpus, k, **search) if pruned else maxsim_topk(queries, corpus, k, **search)
    raise ValueError(f"unknown architecture: {architecture}")


def _vectors(rows: DataFrame, id_col: str) -> DataFrame:
    payload = [c for c in ("embedding", "tokens") if c in rows.columns]
    return rows.select(*KEYS, id_col, *payload)


def recall(hits: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Share of each bundle's exact top ``k`` that ``hits`` holds."""
    keys = [*KEYS, "query_id", "document_id"]
    got = hits.filter(F.col("rank") <= k).select(*keys, F.lit(1).alias("hit"))
    return (
        exact.filter(F.col("rank") <= k)
        .join(got, keys, "left")
        .groupBy(*KEYS)
        .agg((F.count("hit") / F.count(F.lit(1))).alias("recall"), F.count(F.lit(1)).alias("wanted"))
    )
