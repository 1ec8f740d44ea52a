"""Pairs that cannot reach a floor get no exact score; blocks are as large as a task holds, whatever a chunk is."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from negsift.operators import topk as top
from negsift.operators.retrieve import knn
from negsift.operators.scorers import CentroidMaxSim, Dense, MaxSim, ProductCodes, SmallestCell
from rows import as_set, vectors


class Shared:
    def __init__(self, value):
        self.value = value


KEY = ("s", "x", 2)


def _table(rng, kind, n):
    if kind == "dense":
        return pa.table({"embedding": pa.array(list(rng.normal(size=(n, 8)) * rng.lognormal(size=(n, 1))), pa.list_(pa.float64()))})
    if kind == "tokens":
        return pa.table({"tokens": pa.array([[list(v) for v in text] for text in rng.normal(size=(n, 3, 4))], pa.list_(pa.list_(pa.float64())))})
    return pa.table({"codes": pa.array(list(rng.integers(0, 6, (n, 3)).astype(np.int32)), pa.list_(pa.int32()))})


def _cells(rng, table):
    cells = [sorted(set(rng.integers(0, 4, 2).tolist()) | {2}) for _ in range(table.num_rows)]
    return table.append_column("cells", pa.array(cells, pa.list_(pa.int32())))


def _scorers(rng):
    centers, books = {KEY[:2]: rng.normal(size=(6, 4))}, {KEY[:2]: [rng.normal(size=(6, 4)) for _ in range(2)]}
    for metric in ("cosine", "ip", "l2"):
        yield Dense(metric), "dense", "dense", metric == "l2"
        pieces = {KEY[:2]: [rng.normal(size=(6, 3))[:, :3] for _ in range(3)]}
        yield ProductCodes(metric, Shared({KEY[:2]: rng.normal(size=(6, 9))}), Shared(pieces)), "nine", "codes", metric == "l2"
    yield MaxSim(), "tokens", "tokens", False
    yield CentroidMaxSim(Shared(centers)), "tokens", "codes", False


def test_likely_pairs_hold_all_that_reach_the_floor():
    rng = np.random.default_rng(8)
    for scorer, asked, held, ascending in _scorers(rng):
        left = pa.table({"embedding": pa.array(list(rng.normal(size=(30, 9))), pa.list_(pa.float64()))}) if asked == "nine" else _table(rng, asked, 30)
        right = _table(rng, held, 200)
        for cells in (False, True):
            if cells:
                if asked == "nine" or asked == "dense":
                    continue
                # A class of documents shares its cells, as codes and cells do.
                left = _cells(rng, left)
                own = [[2] if held == "tokens" else sorted({*codes, 2}) for codes in right[held].to_pylist()]
                right, scorer = right.append_column("cells", pa.array(own, pa.list_(pa.int32()))), SmallestCell(scorer)
            q, d = scorer.queries(left, KEY), scorer.docs(right, KEY)
            whole = scorer.score(q, 0, 30, d)
            signed = -whole if ascending else whole
            floor = np.sort(signed, axis=1)[:, -7]
            if not np.isfinite(floor).all():
                continue
            row, col = scorer.likely(q, 0, 30, d, floor, 200)
            assert len(row) < 30 * 200
            assert {*zip(*np.nonzero(signed >= floor[:, None]))} <= {*zip(row, col)}
            assert np.allclose(scorer.pairs(q, row, d, col), whole[row, col], atol=1e-12)


def test_blocks_do_not_shrink_with_chunks(spark, monkeypatch):
    """Chunks of 20 documents made blocks of 20, and a copy of each query for each of them."""
    seen = []
    plain = top._against_blocks
    monkeypatch.setattr(top, "_against_blocks", lambda q, d, search, *rows: seen.append(rows) or plain(q, d, search, *rows))
    points = np.random.default_rng(2).normal(size=(300, 8))
    q, d = vectors(spark, [(f"q{i}", v) for i, v in enumerate(points[:20])], "query_id"), vectors(spark, [(f"d{i}", v) for i, v in enumerate(points)], "document_id")
    names = ("query_id", "document_id", "rank")
    want = as_set(knn(q, d, 5), *names)
    assert as_set(knn(q, d, 5, form="blocks", doc_block=20, query_block=7), *names) == want
    assert all(min(rows) >= 300 for rows in seen)
    for metric in ("cosine", "l2"):
        options = {"form": "blocks", "block_rows": 40, "doc_block": 16, "floor_rows": 1, "floor_share": 4}
        assert as_set(knn(q, d, 5, metric, **options), *names) == as_set(knn(q, d, 5, metric), *names)
    assert (40, 40) in seen


def test_meetings_of_blocks_are_a_task_each(spark, monkeypatch):
    """Spark joined them by their bytes, so that the longest task held as many as were small enough."""
    points = np.random.default_rng(3).normal(size=(300, 8))
    q, d = vectors(spark, [(f"q{i}", v) for i, v in enumerate(points)], "query_id"), vectors(spark, [(f"d{i}", v) for i, v in enumerate(points)], "document_id")
    q, d = q.unionByName(vectors(spark, [("one", points[0])], "query_id", lang="y")), d.unionByName(vectors(spark, [("one", points[0])], "document_id", lang="y"))
    names = ("lang", "query_id", "document_id", "rank")
    want = as_set(knn(q, d, 5), *names)
    of_cells = as_set(knn(q, d, 5, method="ivf", nlist=6, nprobe=3), *names)
    monkeypatch.setattr(top, "TASK_PAIRS", 100)
    options = {"form": "blocks", "block_rows": 40}
    sent = top.emitted(q, d, 5, Dense("cosine"), **options).withColumn("task", F.spark_partition_id())
    of_task = sent.filter("lang = 'x'").groupBy("task").agg(F.count_distinct("query_id").alias("queries")).collect()
    assert len(of_task) == 64
    assert max(r["queries"] for r in of_task) < 80
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2
    assert as_set(knn(q, d, 5, **options), *names) == want
    assert as_set(knn(q, d, 5, **options, floor_rows=1, floor_share=4), *names) == want
    assert as_set(knn(q, d, 5, method="ivf", nlist=6, nprobe=3, **options), *names) == of_cells


def test_a_block_with_floors_sends_k_rows_at_most(spark):
    points = np.random.default_rng(4).normal(size=(300, 8))
    q, d = vectors(spark, [(f"q{i}", v) for i, v in enumerate(points[:20])], "query_id"), vectors(spark, [(f"d{i}", v) for i, v in enumerate(points)], "document_id")
    sent = top.emitted(q, d, 5, Dense("cosine"), form="blocks", doc_block=20, floor_rows=1, floor_share=4)
    assert sent.count() == 20 * 5


def test_texts_are_split_in_bounded_runs(monkeypatch):
    """The words of an Arrow batch were held together, so memory grew with its texts."""
    from negsift.functions import vectors as v

    monkeypatch.setattr(v, "RUN_BYTES", 10)
    monkeypatch.setattr(v, "RUN_TEXTS", 3)
    texts = pa.array(["abc", None, "", "x" * 40, "de", "fghij", "k", "lmnop"])
    found = v.text_runs(texts)
    assert [at for run in found for at in range(*run)] == list(range(8))
    sizes = [[len(t or "") for t in texts.slice(lo, hi - lo).to_pylist()] for lo, hi in found]
    assert all(len(s) <= 3 and (sum(s) <= 10 or len(s) == 1) for s in sizes)
    assert v.text_runs(texts.slice(0, 0)) == []
