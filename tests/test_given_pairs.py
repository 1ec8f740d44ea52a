"""Given pairs and held hits in bounded pieces."""

import numpy as np
import pyarrow as pa
import pytest

from negsift.operators import late, topk
from negsift.schema import KEYS

K = "dataset string, lang string, "


def sides(spark, queries=30, documents=40, seed=3):
    rng = np.random.default_rng(seed)
    tokens = lambda: rng.normal(size=(2, 4)).round(3).tolist()
    rows = lambda name, n: [("s", lang, f"{name}{i}", tokens()) for lang in "xy" for i in range(n)]
    q, d = rows("q", queries) + [("s", "x", "q0", tokens()), ("s", "x", None, tokens())], rows("d", documents)
    pairs = [("s", lang, f"q{i}", f"d{j}") for lang in "xy" for i in range(queries) for j in range(documents) if (i * j) % 3 == 0]
    pairs += [("s", "x", "absent", "d1"), ("s", "x", "q1", "absent"), ("s", "x", None, "d1")]
    frame = lambda rows, columns: spark.createDataFrame(rows, K + columns)
    return (
        frame(pairs, "query_id string, document_id string"), frame(q, "query_id string, tokens array<array<double>>"),
        frame(d, "document_id string, tokens array<array<double>>"), (pairs, q, d),
    )


def by_hand(pairs, queries, documents, every):
    asked, held = {}, {tuple(r[:3]): np.array(r[3]) for r in documents}
    for r in queries:
        asked.setdefault(tuple(r[:3]), []).append(np.array(r[3]))
    out = []
    for *key, q, d in pairs:
        found = asked.get((*key, q), []) if q is not None else []
        for a in found if every else found[-1:]:
            if (*key, d) in held:
                out.append((*key, q, d, round(float((a @ held[(*key, d)].T).max(axis=1).sum()), 6)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 25, 1_500])
def test_slices_and_buckets_score_each_pair_once(spark, monkeypatch, block_bytes):
    """Queries beyond a broadcast: of one slice, and of many; an id that repeats, one that is null and ids that are not there."""
    monkeypatch.setattr(late, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(late, "WANTED", 4)
    pairs, queries, documents, rows = sides(spark)
    for limit, every in ((0, True), (1 << 28, False)):
        found = late.exact_scores(pairs, queries, documents, limit).collect()
        assert sorted((*r[:4], round(r["score"], 6)) for r in found) == by_hand(*rows, every)


def test_a_broadcast_counts_what_a_task_holds(spark):
    """Queries are doubles in a task, and stand there with their ids."""
    pairs, queries, documents, _ = sides(spark)
    size, _ = topk.size_in_bytes(queries)
    plan = lambda limit: late.exact_scores(pairs, queries, documents, limit)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan(size + 1) and "CoGroup" not in plan(4 * size)


def test_pairs_leave_in_pieces(monkeypatch):
    monkeypatch.setattr(late, "SCORED", 50)
    rng = np.random.default_rng(1)
    tokens = rng.normal(size=(60, 2, 4)).tolist()
    part = pa.table({"query_id": [f"q{i}" for i in range(60)], "tokens": tokens})
    lists = {"dataset": ["s"] * 30, "lang": ["x"] * 30, "document_id": [f"d{i}" for i in range(30)], "_queries": [[f"q{(i + j) % 60}" for j in range(20)] for i in range(30)], "_d": tokens[:30]}
    batches = list(late._scored(pa.RecordBatch.from_pydict(lists), {("s", "x"): late._Asked(part)}, False))
    assert max(b.num_rows for b in batches) < 50 + 20 and sum(b.num_rows for b in batches) == 600
    for r in pa.Table.from_batches(batches).slice(90, 40).to_pylist():
        a, b = tokens[int(r["query_id"][1:])], tokens[int(r["document_id"][1:])]
        assert abs(r["score"] - (np.array(a) @ np.array(b).T).max(axis=1).sum()) < 1e-8


class _Line:
    """Scores that rise with the document, so that every chunk beats those before it."""

    query_columns = doc_columns = ["x"]
    doc_block, query_block, light, first_block = 10, 1 << 20, True, 10

    def queries(self, table, key):
        return table["x"].to_numpy().astype(float)

    docs = queries

    def query_powers(self, q):
        return np.zeros(len(q), np.int64)

    doc_powers = query_powers

    def score(self, q, start, stop, d):
        return q[start:stop, None] + d[None, :]


def test_hits_held_of_a_block_are_few(monkeypatch):
    """What a task holds until it sends the best k is a few k for each query, however many documents there are."""
    monkeypatch.setattr(topk, "HELD_LEAST", 0)
    most, best_rows = [], topk.best_rows
    monkeypatch.setattr(topk, "best_rows", lambda row, *args: most.append(len(row)) or best_rows(row, *args))
    search = topk._Search(_Line(), 5, KEYS, False, 10, None, "", True)
    left = pa.table({"query_id": ["a", "b"], "x": [0, 1000], "_floor": pa.array([None, None], pa.float64())})
    right = pa.table({"document_id": [f"d{i:04}" for i in range(2_000)], "x": list(range(2_000))})
    out = pa.Table.from_batches(list(search.run(("s", "x"), left, right))).to_pylist()
    assert max(most) <= 2 * 5 * topk.HELD_HITS + 2 * 5
    assert sorted((r["query_id"], r["document_id"], r["score"]) for r in out) == [(q, f"d{i}", float(i + x)) for q, x in (("a", 0), ("b", 1000)) for i in range(1995, 2000)]
