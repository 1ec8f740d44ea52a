"""Top-k against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.llm import maxscore as M


def brute(rows, k, scale):
    """rows: (id, vector, asks)."""
    live = []
    for i, v, asks in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        live.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in v], asks))
    out = []
    for a, (q, w, asks) in enumerate(live):
        if asks:
            scored = sorted((-sum(x * y for x, y in zip(w, u)), i, b) for b, (i, u, _) in enumerate(live) if b != a)
            out += [(q, n + 1, i, -s) for n, (s, i, _) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k, scale=64, **sizes):
    df = spark.createDataFrame([(i, v, a) for i, v, a in rows], "vec_id long, embedding array<float>, asks boolean")
    found = M.topk(df, F.col("asks"), k, scale, **sizes)
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect())


@pytest.mark.parametrize("shape", ["random", "ties", "sparse", "positive"])
def test_against_all_products(spark, shape):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 0.2, (500, 12))
    if shape == "ties":
        x = np.round(x * 2) / 64
    if shape == "sparse":
        x = x * (rng.random(x.shape) < 0.2)
    if shape == "positive":
        x = np.abs(x) ** 3
    rows = [(int(i), v.astype(np.float32).tolist(), i % 20 == 0) for i, v in enumerate(x)]
    assert run(spark, rows, 7, shard_rows=60, query_rows=10) == brute(rows, 7, 64)


def test_floors_drop_rows_early():
    """With a floor, only rows that reach it come out, and all of them."""
    rng = np.random.default_rng(6)
    table, asked = rng.integers(-9, 10, (400, 20)), rng.integers(-9, 10, (5, 20))
    import pyarrow as pa

    postings = M.Postings(pa.array(table.tolist(), pa.list_(pa.int64())), 20)
    scores = asked @ table.T
    floors = np.sort(scores, axis=1)[:, -10].astype(float)
    query, row, score = M.search(postings, asked, floors)
    assert sorted(zip(query, row, score)) == sorted((q, r, scores[q, r]) for q, r in np.argwhere(scores >= floors[:, None]))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.5], True), (0, [0.5, 0.5], True), (1, None, True), (2, [None, 0.1], True), (3, [nan, 0.1], True),
        (4, [inf, 0.1], False), (None, [0.9, 0.9], True), (5, [], True), (6, [0.1], False), (7, [0.2, 0.3, -0.4], True), (8, [0.0, 0.0], False),
    ]
    assert run(spark, rows, 3) == brute([(i, v, a) for i, v, a in rows], 3, 64)
    assert run(spark, [], 3) == []




def test_large_weights_stay_exact(spark):
    rows = [(i, [3.0e7 + 8 * i, -2.0e7], i == 0) for i in range(6)]
    assert run(spark, rows, 5) == brute(rows, 5, 64)


def test_sums_beyond_64_bits_on_the_way(spark):
    """Products of 2^64 that cancel: the scores fit, so they are exact."""
    big = float(1 << 26)
    rows = [(i, [big, big * (-1) ** i, float(i)], i < 3) for i in range(0, 9, 2)] + [(i, [-big, big, float(i)], i < 3) for i in range(1, 9, 2)]
    assert run(spark, rows, 2, scale=1 << 4) == brute(rows, 2, 1 << 4)
    near = [(0, [big, big, 1.0], True), (1, [big, -big, 3.0], False), (2, [-big, big, 5.0], False)]
    assert run(spark, near, 2, scale=1 << 6) == [(0, 1, 2, 5 << 12), (0, 2, 1, 3 << 12)]


@pytest.mark.parametrize("value", [4.0e9, 1.0e18])
def test_scores_that_no_long_holds_are_an_error(spark, value):
    with pytest.raises(Exception, match="beyond 64 bits"):
        run(spark, [(0, [value], True), (1, [value], False)], 1)
