"""Centroids of all bundles together, and codes after a rotation."""

import numpy as np
import pytest

from negsift.operators import cells, lloyd, rotation
from negsift.operators.retrieve import knn, recall
from test_graph import clustered, rows


def plain(points, seeds, turns):
    now = seeds.copy()
    for _ in range(turns):
        at = ((points[:, None] - now[None]) ** 2).sum(2).argmin(1)
        now = np.array([points[at == c].mean(0) if (at == c).any() else now[c] for c in range(len(now))])
    return now


def test_equals_plain_steps(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(300, 5)), rng.normal(size=(90, 5)) + 3
    both = rows(spark, a, "document_id", "a").unionByName(rows(spark, b, "document_id", "b")).repartition(5)
    as32 = lambda x: x.astype(np.float32).astype(float)
    seeds = {("s", "a"): as32(a)[:7], ("s", "b"): as32(b)[:3]}
    found = lloyd.lloyd(both, seeds, 4)
    assert np.allclose(found["s", "a"], plain(as32(a), as32(a)[:7], 4)) and np.allclose(found["s", "b"], plain(as32(b), as32(b)[:3], 4))


def test_jobs_do_not_grow_with_languages(spark):
    """One pass per turn, whatever the number of bundles."""
    rng = np.random.default_rng(2)
    tracker = spark.sparkContext.statusTracker()

    def jobs(langs):
        many = rows(spark, rng.normal(size=(60, 4)), "document_id", langs[0])
        for lang in langs[1:]:
            many = many.unionByName(rows(spark, rng.normal(size=(60, 4)), "document_id", lang))
        name = f"train-{len(langs)}"
        spark.sparkContext.setJobGroup(name, name)
        found = cells.train_cells(many, 5, turns=3)
        spark.sparkContext.setJobGroup("", "")
        assert sorted(found) == [("s", lang) for lang in langs] and all(len(block) == 5 for block in found.values())
        return len(tracker.getJobIdsForGroup(name))

    one, six = jobs(["a"]), jobs(list("abcdef"))
    assert six <= one + 6  # toLocalIterator reads a partition at a time


def test_seeds_reach_all_clusters():
    points = clustered(np.random.default_rng(3), 12, 40, dim=6, spread=0.05)
    seeds = lloyd.far_seeds(points, 12, 1)
    assert len(np.unique(((seeds[:, None] - points[None]) ** 2).sum(2).argmin(1) // 40)) == 12
    same = lloyd.far_seeds(np.ones((5, 3)), 4, 1)
    assert same.shape == (4, 3) and lloyd.far_seeds(points[:3], 9, 1).shape == (3, 6)


def test_frequent_vectors_do_not_fill_the_sample(spark):
    """One vector in two thirds of the rows: the others are sampled too."""
    rng = np.random.default_rng(4)
    points = np.vstack([np.tile(rng.normal(size=4), (400, 1)), rng.normal(size=(200, 4))])
    sample = lloyd.some_rows(rows(spark, points, "document_id"), 90, 7)["s", "x"]
    assert len(sample) == 90 and len(np.unique(sample, axis=0)) > 15


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_rotation_and_exact_scores_find_more(spark, metric):
    """Vectors whose numbers vary together: nine of ten neighbours, and more than by plain codes."""
    rng = np.random.default_rng(6)
    few = rng.normal(size=(1200, 6)) * np.array([6, 5, 4, 3, 2, 1])
    points = np.hstack([few[:, :3], np.zeros((1200, 5)), few[:, 3:], np.zeros((1200, 5))]) + rng.normal(size=(1200, 16)) * 0.05
    spin, _ = np.linalg.qr(rng.normal(size=(16, 16)))
    points[:, :8] = points[:, :8] @ np.linalg.qr(rng.normal(size=(8, 8)))[0]
    d, q = rows(spark, points, "document_id").cache(), rows(spark, points[::30], "query_id").cache()
    whole = knn(q, d, 10, metric).cache()
    share = lambda hits: recall(hits, whole, 10).first()["recall"]
    index = rotation.build_rotated(d, 4, 4, metric, turns=6)
    turn = index[3]["s", "x"]
    assert np.allclose(turn @ turn.T, np.eye(16), atol=1e-8)
    hits = rotation.rotated_topk(q, d, index, 10, 4, metric)
    assert share(hits) >= 0.9 and hits.join(whole, ["query_id", "document_id", "score"]).count() == share(hits) * 400
    assert share(hits) >= share(knn(q, d, 10, metric, "ivfpq", nlist=4, nprobe=4, m_pq=4))
    with pytest.raises(ValueError):
        rotation.build_rotated(d, 4, 5, metric)


def test_batches_by_budget(spark):
    """Vectors come back in row order, every batch keeps the budget, and less is padded."""
    from negsift.operators.encode import budget_batches, budget_encoder

    rng = np.random.default_rng(8)
    sizes = rng.integers(1, 400, 700)
    padded = lambda runs: sum(int(max(r)) * len(r) - int(sum(r)) for r in runs)
    ordered = np.sort(sizes)
    runs = [ordered[run] for run in budget_batches(ordered, 4000)]
    assert sum(map(len, runs)) == 700 and all(max(r) * len(r) <= 4000 for r in runs)
    assert padded(runs) < 0.2 * padded([sizes[i : i + 20] for i in range(0, 700, 20)])
    assert [r.stop - r.start for r in budget_batches(np.array([5, 9000]), 4000)] == [1, 1] and list(budget_batches(np.array([]), 9)) == []

    def load():
        def predict(texts):
            assert max(map(len, texts)) * len(texts) <= 600 or len(texts) == 1
            return [[float(len(t)), float(t.count("a"))] for t in texts]

        return predict

    texts = ["a" * int(n) + "b" for n in sizes] + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["embedding"] for r in budget_encoder(load, 600)(frame, "t").collect()}
    assert got == {i: [float(len(t or "")), float((t or "").count("a"))] for i, t in enumerate(texts)}
