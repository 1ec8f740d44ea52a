"""Search by ball bounds: equal to exact search, and rings are left out where vectors are clustered."""

import numpy as np
import pytest

from negsift.operators import balls as B
from negsift.operators.retrieve import knn
from rows import as_set, vectors
from test_graph import clustered, rows


def ranks(found):
    return as_set(found, "query_id", "document_id", "rank", "score")


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_exact_and_pruned(spark, metric):
    points = clustered(np.random.default_rng(2), 30, 60)
    d, q = rows(spark, points, "document_id").cache(), rows(spark, points[::40], "query_id").cache()
    balls, counted = B.build_balls(d, 30, metric), []
    found = B.balls_topk(q, balls, 10, metric, nprobe=4, counted=counted)
    assert ranks(found) == ranks(knn(q, d, 10, metric))
    assert B.searched_share(counted, balls).first()["share"] < (0.3 if metric != "ip" else 0.9)


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
@pytest.mark.parametrize("scale", [1e-5, 1.0, 1e5])
def test_exact_on_random_vectors(spark, metric, scale):
    """Copies, zero vectors, several languages, few documents, any scale."""
    rng = np.random.default_rng(9)
    q, d = rng.normal(size=(15, 6)) * scale, rng.normal(size=(200, 6)) * scale
    d[10:30], d[40], q[0] = d[5], 0, 0
    queries, corpus = rows(spark, q, "query_id"), rows(spark, d, "document_id")
    queries, corpus = queries.unionByName(rows(spark, q[:4], "query_id", "y")), corpus.unionByName(rows(spark, d[:3], "document_id", "y"))
    queries = queries.unionByName(rows(spark, q[:1], "query_id", "none"))
    for form in ({}, {"form": "blocks", "doc_block": 20}):
        found = knn(queries, corpus, 7, metric, "ivf_exact", nlist=8, nprobe=2, **form)
        assert ranks(found) == ranks(knn(queries, corpus, 7, metric))


def test_bounds_hold(spark):
    """No score is above the bound of its ring."""
    rng = np.random.default_rng(4)
    q, d, c = rng.normal(size=(30, 5)), rng.normal(size=(80, 5)), rng.normal(size=(3, 5))
    cell = ((d[:, None] - c[None]) ** 2).sum(2).argmin(1)
    far = np.linalg.norm(d - c[cell], axis=1)
    rings = B.Rings(np.arange(80), cell, far, far, np.linalg.norm(d, axis=1), c)
    assert (q @ d.T <= rings.bounds(q, "ip")).all()
    assert (-((q[:, None] - d[None]) ** 2).sum(2) <= rings.bounds(q, "l2")).all()
