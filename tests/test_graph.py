"""Neighbour graph: rounds improve it, searches prune, everything they score is exact."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.operators import graph as G
from negsift.operators.retrieve import knn, recall
from negsift.schema import KEYS
from rows import as_set, vectors


def clustered(rng, clusters, each, dim=16, spread=0.3):
    return np.repeat(rng.normal(size=(clusters, dim)) * 4, each, axis=0) + rng.normal(size=(clusters * each, dim)) * spread


def rows(spark, points, column, lang="x"):
    return vectors(spark, [(f"{column[0]}{i}", v) for i, v in enumerate(points)], column, lang)


def searched(queries, graph, metric, k=10, ef=64):
    found = G.search_graph(queries, graph, G.starts(queries, graph, metric), metric, ef)
    hits = found.filter(F.col("place") <= k).withColumn("rank", F.col("place"))
    return found, hits


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_prunes_clustered_vectors(spark, metric):
    """Nine of ten neighbours for a tenth of the pairs, and a smaller share of ten times the corpus."""
    shares = []
    for clusters in (60, 600) if metric == "cosine" else (60,):
        points = clustered(np.random.default_rng(clusters), clusters, 100)
        d, q = rows(spark, points, "document_id").repartition(8).cache(), rows(spark, points[:: len(points) // 60], "query_id").cache()
        graph = G.build_graph(d, metric)
        found, hits = searched(q, graph, metric)
        shares.append(G.graph_share(found, graph).first()["share"])
        assert recall(hits, knn(q, d, 10, metric), 10).first()["recall"] >= 0.9
    assert shares[0] <= 0.1 and all(b <= a / 2 for a, b in zip(shares, shares[1:]))


def test_scores_are_exact_and_languages_apart(spark):
    rng = np.random.default_rng(3)
    q, d = rng.normal(size=(20, 8)), rng.normal(size=(400, 8))
    d[20:40] = d[3]
    both = lambda x, c: rows(spark, x, c).unionByName(rows(spark, x[: len(x) // 2], c, "y"))
    queries, corpus = both(q, "query_id"), both(d, "document_id")
    for metric in ("cosine", "l2", "ip"):
        pairs = [*KEYS, "query_id", "document_id", "score"]
        found = knn(queries, corpus, 5, metric, "hnsw")
        assert found.count() == 150
        whole = knn(queries, corpus, 400, metric)
        assert found.join(whole, pairs).count() == 150
        assert recall(found, whole, 5).agg(F.min("recall")).first()[0] >= 0.9


def test_rounds_approach_the_nearest(spark):
    """From few random links, rounds find nearly all nearest neighbours."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(300, 6))
    frame = spark.createDataFrame([("s", "x", i, f"d{i}", [float(x) for x in v]) for i, v in enumerate(points)], "dataset string, lang string, node long, document_id string, embedding array<double>")
    apart = ((points[:, None] - points[None]) ** 2).sum(2)
    np.fill_diagonal(apart, np.inf)
    start = [(i, int(j), float(apart[i, j]), True) for i in range(300) for j in rng.choice([x for x in range(300) if x != i], 8, False)]
    links = spark.createDataFrame(start, "node long, other long, far double, fresh boolean")
    want = {(i, int(j)) for i in range(300) for j in np.argsort(apart[i])[:8]}
    hit = []
    for _ in range(4):
        links = spark.createDataFrame(G.improved(links, frame, 8).collect(), links.schema)
        got = as_set(links, "node", "other")
        assert len(got) == 2400 and all(i != j for i, j in got)
        hit.append(len(got & want) / len(want))
    assert hit == sorted(hit) and hit[-1] > 0.95


def test_a_hub_is_bounded(spark):
    """All nodes link to one; what leads back from it is cut to its nearest."""
    links = spark.createDataFrame([(i, 0, float(i), True) for i in range(1, 500)], "node long, other long, far double, fresh boolean")
    back = G.both_ways(links, 4).filter("node = 0")
    assert as_set(back, "other") == {(1,), (2,), (3,), (4,)}


def test_copies_and_small_corpora(spark):
    """A third of the rows is one vector; tiny and empty corpora."""
    points = np.vstack([np.tile([1.0, 0, 0], (200, 1)), np.random.default_rng(1).normal(size=(400, 3))])
    d, q = rows(spark, points, "document_id"), rows(spark, points[[0, 300, 500]], "query_id")
    found = knn(q, d, 10, "l2", "hnsw")
    assert found.count() == 30 and found.filter("query_id = 'q0' and score > 0").count() == 0
    for many in (1, 2, 5):
        some = rows(spark, points[300 : 300 + many], "document_id")
        assert knn(q, some, 3, "cosine", "hnsw").count() == 3 * min(many, 3)
    assert knn(q, d.limit(0), 3, "cosine", "hnsw").count() == 0
    assert knn(q.limit(0), d, 3, "cosine", "hnsw").count() == 0


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_a_search_keeps_its_beam_only(spark, metric):
    """Starts of all queries are no pairs, nothing beyond ``ef`` is kept, and the hits are those of pairs as starts; ids repeat."""
    rng = np.random.default_rng(7)
    q, d = rng.normal(size=(12, 6)), rng.normal(size=(300, 6))
    d[40:60] = d[4]
    corpus = rows(spark, d, "document_id").withColumn("node", F.substring("document_id", 2, 9).cast("long"))
    corpus, queries = corpus.unionByName(corpus.filter("node % 30 = 0")), rows(spark, q, "query_id")
    queries = queries.unionByName(queries.limit(3)).unionByName(queries.limit(1).withColumn("query_id", F.lit(None).cast("string")))
    corpus, queries = corpus.cache(), queries.cache()
    links = corpus.select("node", F.array((F.col("node") + 1) % 300, (7 * F.col("node") + 3) % 300).alias("neighbours")).distinct()
    graph = G.Graph(corpus.select(*KEYS, "node", "document_id", "embedding"), links, {}, None)
    nodes = graph.nodes.filter("node % 5 = 0").select(*KEYS, "node")
    some = lambda found: sorted(map(tuple, found.filter("place <= 5").select("query_id", "document_id", "node", "score", "place").collect()))
    whole = G.search_graph(queries, graph, nodes, metric, 8, 2, 2)
    pairs = G.search_graph(queries, graph, queries.select(*KEYS, "query_id").join(nodes, KEYS), metric, 8, 2, 2)
    assert some(whole) == some(pairs) and len(some(whole)) == 60
    for found in (whole, pairs):
        assert found.groupBy("query_id").count().agg(F.max("count")).first()[0] == 8
        assert found.agg(F.min("met")).first()[0] >= 60


def test_a_hop_shuffles_lists_and_not_neighbours(spark):
    """What a query reaches comes once, and without what it has; no row per neighbour is grouped or joined for that."""
    of_query = [*KEYS, "query_id"]
    name = "dataset string, lang string, query_id string, "
    ranked = spark.createDataFrame([("s", "x", "a", 1), ("s", "x", "a", 2), ("s", "y", "a", 3), ("s", "x", "b", 9)], name + "node long")
    reached = spark.createDataFrame(
        [("s", "x", "a", [2, 5, 5, 7]), ("s", "x", "a", [7, 1, 8]), ("s", "y", "a", [1, 3]), ("s", "x", "c", [4]), ("s", "x", "b", [9]), ("s", "x", "c", [])],
        name + "neighbours array<long>",
    )
    found = G._unseen(reached, ranked, of_query)
    want = [("s", "x", "a", 5), ("s", "x", "a", 7), ("s", "x", "a", 8), ("s", "x", "c", 4), ("s", "y", "a", 1)]
    assert sorted(map(tuple, found.select(*of_query, "node").collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.index("Generate") < plan.index("Exchange")  # what is above stands first
