"""Approximate search over a neighbour graph: a few hundred documents scored per query.

The graph links each document to its ``degree`` nearest ones and back. It starts from the
nearest documents inside small lists (documents of one landmark, cut into chunks of bounded
size), and is improved in rounds: documents that are neighbours of one document are compared with
each other, and each keeps its best links. A round is three joins and one grouping; it
compares only pairs of which one link is new, and the rounds end when few links change.

Landmarks are about ``2 sqrt(n)`` documents of a bundle, ``MOST_LANDMARKS`` at most, by hash of their
id; they are all that is broadcast. A search starts at documents of the landmarks that are closest to the
query, and keeps the best ``ef`` documents seen so far. Every hop follows the links of the ``width``
best ones not yet followed, for all queries in one join, and scores what is not among the ``ef``. What fell behind
them once does so again, so nothing else is kept between hops. It ends when the links of all ``ef`` have been followed. What is
scored per query is about ``2 sqrt(n)`` landmarks and a number that hardly grows with the corpus.

Links are the nearest by distance: of unit vectors for ``cosine``, of vectors with one more
number that makes them all equally long for ``ip``, which puts large products near. Scores are those of exact
search. Documents without a vector are left out; a bundle without documents finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from negsift.operators.cells import Matrices, as_indexed, nearest_cells
from negsift.operators.scorers import Dense, check_metric, inner_or_distance, matrix, powers, unit
from negsift.operators.topk import BROADCAST_BYTES, size_in_bytes, topk
from negsift.schema import KEYS, SCORE_PLACES
from negsift.session import stored

MOST_LANDMARKS = 16_384  # per bundle
CHUNK = 512  # documents of a landmark compared with each other at the start
STARTS, MEMBERS = 4, 16  # landmarks a search starts from, and documents of each
CHANGED = 0.01  # share of new links below which the rounds end


class Graph(NamedTuple):
    nodes: DataFrame  # dataset, lang, node, document_id, embedding
    links: DataFrame  # node, neighbours
    landmarks: Matrices
    members: DataFrame  # dataset, lang, cell, members: where a search starts


def placed(rows: DataFrame, metric: str, longest: dict[tuple[str, str], float] | None = None) -> DataFrame:
    """``embedding`` replaced by the vector whose distances the graph goes by.

    For ``ip``, documents get one more number, up to the squared length of the longest of their bundle
    (``longest``); queries get a zero.
    """
    check_metric(metric)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def place(dataset: pa.Array, lang: pa.Array, vectors: pa.Array) -> pa.Array:
        block = as_indexed(matrix(pa.chunked_array([vectors])), metric)
        if metric == "ip":
            most = [(longest or {}).get(key, 0.0) for key in zip(dataset.to_pylist(), lang.to_pylist())]
            block = np.hstack([block, np.sqrt(np.maximum(np.array(most) - (block * block).sum(1), 0.0))[:, None]])
        starts = np.arange(len(block) + 1, dtype=np.int32) * block.shape[1]
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.ascontiguousarray(block).ravel()))

    return rows.withColumn("embedding", place.asNondeterministic()("dataset", "lang", "embedding"))


def longest_of(rows: DataFrame) -> dict[tuple[str, str], float]:
    """Squared length of the longest vector of each bundle."""
    size = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return {(r["dataset"], r["lang"]): r["most"] for r in rows.groupBy(*KEYS).agg(F.max(size).alias("most")).collect()}


def pick_landmarks(points: DataFrame) -> Matrices:
    """Some vectors of each bundle, by hash of the id: ``2 sqrt(n)``, at most ``MOST_LANDMARKS``."""
    order = W.partitionBy(*KEYS).orderBy(F.xxhash64("document_id"), "document_id")
    first = points.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= MOST_LANDMARKS)
    sizes = points.groupBy(*KEYS).agg(F.ceil(2 * F.sqrt(F.count(F.lit(1)))).alias("_many"))
    chosen = first.join(F.broadcast(sizes), KEYS).filter(F.col("_place") <= F.col("_many"))
    out: dict[tuple, list] = {}
    for row in chosen.select(*KEYS, "embedding", "_place").orderBy(*KEYS, "_place").toLocalIterator():
        out.setdefault((row["dataset"], row["lang"]), []).append(row["embedding"])
    return {key: np.array(vectors) for key, vectors in out.items()}


def first_links(points: DataFrame, landmarks: Matrices, degree: int) -> DataFrame:
    """``node, other, far, fresh``: the nearest documents among those of a landmark's chunk."""
    near = points.withColumn("cells", nearest_cells(points, landmarks, 2, "l2"))
    listed = near.select(*KEYS, "node", "embedding", F.explode("cells").alias("cell"))
    listed = stored(listed, "landmark-lists")
    # A row per landmark.
    sizes = F.broadcast(listed.groupBy(*KEYS, "cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("_chunks")))
    chunk = F.pmod(F.xxhash64("node", "cell"), F.col("_chunks")).cast("int")
    listed = listed.join(sizes, [*KEYS, "cell"]).withColumn("chunk", chunk).drop("_chunks")
    name = F.col("node").cast("string")
    found = topk(
        listed.withColumn("query_id", name), listed.withColumn("document_id", name), degree + 1, Dense("l2"),
        keys=[*KEYS, "cell", "chunk"], ascending=True, once=False, form="blocks", doc_block=CHUNK * 4, query_block=CHUNK * 4, floor_rows=1 << 62,
    )
    links = found.select(F.col("query_id").cast("long").alias("node"), F.col("document_id").cast("long").alias("other"), F.col("score").alias("far"))
    return best_links(links.filter("node <> other").withColumn("fresh", F.lit(True)), degree)


def best_links(links: DataFrame, degree: int, by: str = "node") -> DataFrame:
    """The ``degree`` nearest of each node; a node that very many link to is cut in every task."""
    other = "other" if by == "node" else "node"
    place = F.row_number().over(W.partitionBy(by).orderBy("far", other))
    return links.withColumn("_place", place).filter(F.col("_place") <= degree).drop("_place")


def both_ways(links: DataFrame, degree: int) -> DataFrame:
    """Links and the nearest of those that lead back: at most twice ``degree`` per node."""
    back = best_links(links, degree, "other").select(F.col("other").alias("node"), F.col("node").alias("other"), "far", "fresh")
    both = links.select("node", "other", "far", "fresh").unionByName(back)
    return both.groupBy("node", "other").agg(F.min("far").alias("far"), F.max("fresh").alias("fresh"))


def _compare(degree: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            each = lists.flatten()
            ids, fresh = each.field("other").to_numpy(), each.field("fresh").to_numpy(zero_copy_only=False)
            worst = each.field("worst").to_numpy(zero_copy_only=False)
            vectors = matrix(pa.chunked_array([each.field("embedding")]))
            node, other, far = [], [], []
            for lo, hi in zip(at[:-1], at[1:]):
                block, new = vectors[lo:hi], fresh[lo:hi]
                apart = inner_or_distance(block, block, "l2")
                apart[~(new[:, None] | new[None, :])] = np.inf
                np.fill_diagonal(apart, np.inf)
                near = np.argsort(apart, axis=1, kind="stable")[:, :degree]
                values = np.take_along_axis(apart, near, axis=1)
                # Only what can take the place of a link: a node keeps its ``degree`` nearest. The slack covers rounding.
                limit = worst[lo:hi, None] * (1 + 1e-6) + 1e-6
                row, col = np.nonzero(np.isfinite(values) & (values <= limit))
                node.append(ids[lo:hi][row])
                other.append(ids[lo:hi][near[row, col]])
                far.append(np.round(values[row, col], SCORE_PLACES))
            columns = [np.concatenate(c) if c else np.zeros(0, k) for c, k in ((node, np.int64), (other, np.int64), (far, float))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "other", "far"])

    return run


def improved(links: DataFrame, points: DataFrame, degree: int) -> DataFrame:
    """One round: neighbours of a node meet each other, and every node keeps its best links."""
    full = F.when(F.count(F.lit(1)) >= degree, F.max("far")).otherwise(F.lit(float("inf")))
    worst = links.groupBy(F.col("node").alias("other")).agg(full.alias("worst"))
    known = points.select(F.col("node").alias("other"), "embedding").join(worst, "other", "left").fillna(float("inf"), ["worst"])
    around = both_ways(links, degree).join(known, "other")
    # At most twice ``degree`` vectors a node.
    groups = around.groupBy("node").agg(F.collect_list(F.struct("other", "fresh", "embedding", "worst")).alias("around")).filter(F.size("around") > 1)
    met = groups.select("around").mapInArrow(_compare(degree), "node long, other long, far double")
    known = links.select("node", "other", "far", F.lit(False).alias("fresh"))
    merged = known.unionByName(met.withColumn("fresh", F.lit(True)))
    merged = merged.groupBy("node", "other").agg(F.min("far").alias("far"), F.min("fresh").alias("fresh"))
    return best_links(merged, degree)


def build_graph(corpus: DataFrame, metric: str = "cosine", degree: int = 16, rounds: int = 8) -> Graph:
    """The neighbour graph of every bundle's ``embedding`` column."""
    check_metric(metric)
    nodes = corpus.select(*KEYS, "document_id", "embedding").filter(F.size("embedding") > 0)
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "graph-nodes")
    longest = longest_of(nodes) if metric == "ip" else None
    points = stored(placed(nodes, metric, longest).select(*KEYS, "node", "document_id", "embedding"), "graph-points")
    landmarks = pick_landmarks(points)
    links = stored(first_links(points, landmarks, degree), "links")
    for _ in range(rounds):
        links = stored(improved(links, points, degree), "links")
        all_of, fresh = links.agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if fresh <= CHANGED * all_of:
            break
    near = points.withColumn("cell", F.get(nearest_cells(points, landmarks, 1, "l2"), F.lit(0)))
    place = F.row_number().over(W.partitionBy(*KEYS, "cell").orderBy(F.xxhash64("node"), "node"))
    members = near.select(*KEYS, "cell", "node").withColumn("_place", place).filter(F.col("_place") <= MEMBERS)
    members = stored(members.groupBy(*KEYS, "cell").agg(F.collect_list("node").alias("members")), "graph-members")
    neighbours = both_ways(links, degree).groupBy("node").agg(F.collect_list("other").alias("neighbours"))
    return Graph(nodes, stored(neighbours, "graph-links"), landmarks, members)


def pair_score(metric: str):
    """Score of each row's two vectors, rounded as exact search rounds it."""

    @F.arrow_udf(T.DoubleType())
    def score(queries: pa.Array, documents: pa.Array) -> pa.Array:
        if not len(queries):
            return pa.array([], pa.float64())
        q, d = matrix(pa.chunked_array([queries])), matrix(pa.chunked_array([documents]))
        if q.shape[1] != d.shape[1]:
            raise ValueError("vectors differ in their number of dimensions")
        size = np.zeros(len(q))
        if metric == "cosine":
            q, d = unit(q), unit(d)
        else:
            size = (powers(np.linalg.norm(q, axis=1)) + powers(np.linalg.norm(d, axis=1))).astype(float)
        dot = np.einsum("ij,ij->i", q, d)
        if metric == "l2":
            dot = np.maximum((q * q).sum(1) + (d * d).sum(1) - 2 * dot, 0.0)
        factor = 10.0 ** (SCORE_PLACES - size)
        return pa.array(np.rint(dot * factor) / factor + 0.0)

    return score


def search_graph(
    queries: DataFrame, graph: Graph, start: DataFrame, metric: str, ef: int, width: int = 16, hops: int = 64, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The best ``ef`` documents that a search meets: ``dataset, lang, query_id, document_id, node, score, place, met``.

    ``start`` has the first ones as ``dataset, lang, query_id, node``; without ``query_id`` every query of a bundle starts from
    all of its nodes, and these pairs are no rows. ``place`` ranks a query's rows, and ``met`` says how many scores
    it took. Each hop is written to the shared folder, so a lost executor costs no earlier hop.
    """
    of_query, ascending = [*KEYS, "query_id"], metric == "l2"
    asked = queries.select(*of_query, F.col("embedding").alias("_q"))
    if 3 * size_in_bytes(asked)[0] <= broadcast_bytes:
        asked = F.broadcast(asked)
    documents = graph.nodes.select("node", "document_id", F.col("embedding").alias("_d"))
    score = pair_score(metric)

    def scored(pairs: DataFrame) -> DataFrame:
        rows = pairs.join(documents, "node").join(asked, of_query)
        return rows.select(*of_query, "node", "document_id", score("_q", "_d").alias("score"), F.lit(False).alias("followed"), F.lit(None).cast("long").alias("met"))

    order = [F.asc("score") if ascending else F.desc("score"), "document_id"]
    seen = scored(start.distinct()) if "query_id" in start.columns else _best_of_all(queries, graph, start, metric, ef, broadcast_bytes)
    for _ in range(hops + 1):
        whole = W.partitionBy(*of_query)
        ranked = seen.withColumn("place", F.row_number().over(whole.orderBy(*order)))
        ranked = ranked.withColumn("met", F.coalesce(F.max("met").over(whole), F.lit(0)) + F.count_if(F.col("met").isNull()).over(whole))
        waits = (F.col("place") <= ef) & ~F.col("followed")
        turn = F.count_if(waits).over(whole.orderBy("place").rowsBetween(W.unboundedPreceding, 0))
        ranked = stored(ranked.withColumn("now", waits & (turn <= width)).filter(F.col("place") <= ef), "beam")
        now = ranked.filter("now")
        if now.isEmpty():
            break
        new = _unseen(now.select(*of_query, "node").join(graph.links, "node"), ranked, of_query)
        followed = ranked.withColumn("followed", F.col("followed") | F.col("now")).drop("place", "now")
        seen = followed.unionByName(scored(new))
    return ranked.drop("followed", "now")


def _unseen(reached: DataFrame, ranked: DataFrame, of_query: list[str]) -> DataFrame:
    """The ``neighbours`` that a query reached, once each, without the nodes of its ``ranked`` rows: ``of_query``, ``node``.

    Lists travel, and are compared in the task of their query; a row for each neighbour would be shuffled twice.
    """
    none = F.lit(None).cast(dict(reached.dtypes)["neighbours"])
    lists = reached.select(*of_query, "neighbours", none.alias("had")).unionByName(
        ranked.select(*of_query, none.alias("neighbours"), F.array("node").cast(dict(reached.dtypes)["neighbours"]).alias("had"))
    )
    flat = lambda name: F.flatten(F.collect_list(name))
    met = lists.groupBy(*of_query).agg(F.array_except(flat("neighbours"), flat("had")).alias("node"))
    return met.withColumn("node", F.explode("node"))


def _best_of_all(queries: DataFrame, graph: Graph, start: DataFrame, metric: str, ef: int, broadcast_bytes: int) -> DataFrame:
    """The best ``ef`` of the nodes ``start`` for every query of their bundle, as the first rows of a search."""
    nodes = graph.nodes.join(start.select(*KEYS, "node").distinct(), [*KEYS, "node"])
    nodes = stored(nodes.select(*KEYS, "node", "document_id", "embedding"), "starts")
    # The node goes with the id, behind a character that sorts before all others.
    both = nodes.withColumn("document_id", F.concat_ws("\0", "document_id", F.col("node").cast("string")))
    asked = queries.filter(F.col("query_id").isNotNull())
    found = topk(asked, both, ef, Dense(metric), ascending=metric == "l2", broadcast_bytes=broadcast_bytes)
    node, whole = F.substring_index("document_id", "\0", -1), F.length("document_id")
    name = F.when(F.length(node) < whole, F.left("document_id", whole - F.length(node) - 1))
    sizes = nodes.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("met"))  # a row per bundle
    return found.join(F.broadcast(sizes), KEYS).select(
        *KEYS, "query_id", node.cast(dict(nodes.dtypes)["node"]).alias("node"), name.alias("document_id"), "score", F.lit(False).alias("followed"), "met"
    )


def starts(queries: DataFrame, graph: Graph, metric: str) -> DataFrame:
    """Documents of the landmarks closest to each query."""
    points = placed(queries, metric).select(*KEYS, "query_id", "embedding")
    near = points.withColumn("cells", nearest_cells(points, graph.landmarks, STARTS, "l2"))
    asked = near.select(*KEYS, "query_id", F.explode("cells").alias("cell"))
    return asked.join(graph.members, [*KEYS, "cell"]).select(*KEYS, "query_id", F.explode("members").alias("node"))


def graph_topk(
    queries: DataFrame, corpus: DataFrame | None, k: int, metric: str = "cosine", degree: int = 16, ef: int | None = None, width: int = 16,
    graph: Graph | None = None, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The best ``k`` documents that a search of the graph meets; ``ef`` is at least ``k``, by default ``max(2 k, 64)``."""
    graph = build_graph(corpus, metric, degree) if graph is None else graph
    ef = max(k, ef or max(2 * k, 64))
    found = search_graph(queries, graph, starts(queries, graph, metric), metric, ef, width, broadcast_bytes=broadcast_bytes)
    return found.filter(F.col("place") <= k).select(*KEYS, "query_id", "document_id", "score", F.col("place").alias("rank"))


def graph_share(found: DataFrame, graph: Graph) -> DataFrame:
    """Per bundle: documents and landmarks scored, as a share of all pairs; ``found`` from :func:`search_graph`."""
    found = found.groupBy(*KEYS, "query_id").agg(F.max("met").alias("met"))
    many = found.sparkSession.createDataFrame([(*key, len(v)) for key, v in graph.landmarks.items()], "dataset string, lang string, landmarks long")
    met = found.groupBy(*KEYS).agg(F.sum("met").alias("met"), F.count(F.lit(1)).alias("queries"))
    sizes = graph.nodes.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("documents"))
    both = met.join(sizes, KEYS).join(many, KEYS)
    return both.withColumn("share", (F.col("met") + F.col("queries") * F.col("landmarks")) / (F.col("queries") * F.col("documents")))
