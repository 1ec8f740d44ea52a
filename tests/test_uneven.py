"""Late interaction of texts of unequal length: by distinct tokens, and in single precision under floors."""

import numpy as np
import pyarrow as pa
import pytest

from negsift.operators.scorers import Dense, MaxSim, Ragged, distinct


def ragged(texts):
    return Ragged(pa.chunked_array([pa.array([[list(map(float, v)) for v in x] for x in texts], pa.list_(pa.list_(pa.float64())))]))


def texts(rng, counts, dim=6, words=3000):
    book = rng.normal(size=(words, dim))
    return [book[rng.integers(0, words, n)] for n in counts]


def plain(q, d):
    return np.array([[(a @ b.T).max(axis=1).sum() if len(a) and len(b) else 0.0 for b in d] for a in q])


@pytest.mark.parametrize("cells", [8_000_000, 64])
def test_scores_and_likely_pairs(cells, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(MaxSim, "cells", cells)
    monkeypatch.setattr(MaxSim, "side", 8)
    q = texts(rng, [0, 3, 9, 1, 30, 2])
    d = texts(rng, [5, 0, 1, 700, *rng.integers(1, 40, 300)])
    want, scorer, a, b = plain(q, d), MaxSim(), ragged(q), ragged(d)
    assert not scorer.even(a, b)
    np.testing.assert_allclose(scorer.score(a, 0, 6, b), want, rtol=0, atol=1e-10)
    np.testing.assert_allclose(scorer.score(a, 2, 5, b), want[2:5], rtol=0, atol=1e-10)
    floor = np.sort(want[1:], axis=1)[:, -5]
    near = scorer.likely(a, 1, 6, b, floor, 5)
    assert near is not None, "uneven texts had no likely pairs"
    row, col = near
    assert len(row) < 60 and {(i, j) for i, j in zip(*np.nonzero(want[1:] >= floor[:, None]))} <= set(zip(row.tolist(), col.tolist()))
    np.testing.assert_allclose(scorer.pairs(a, row + 1, b, col), want[row + 1, col], rtol=0, atol=1e-10)
    assert scorer.likely(a, 0, 6, b, np.zeros(6), 5) is None, "where most pairs reach the floor all are scored together"


def test_distinct_rows():
    rows = np.array([[1.0, 2], [3, 4], [1, 2], [-0.0, 1], [0, 1]])
    found, own = distinct(rows)
    assert len(found) == 3 and np.array_equal(found[own], rows)
    odd = np.array([[np.nan, 1.0], [1, 1]])
    assert np.array_equal(distinct(odd)[0], odd, equal_nan=True)


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_given_pairs_are_scored_in_pieces(metric):
    """Memory does not grow with the number of likely pairs times their vectors."""
    import tracemalloc

    rng = np.random.default_rng(2)
    table = lambda n: pa.table({"embedding": pa.array(rng.normal(size=(n, 64)).tolist(), pa.list_(pa.float64()))})
    scorer = Dense(metric)
    q, d = scorer.queries(table(50), ()), scorer.docs(table(400), ())
    row, col = rng.integers(0, 50, 100_000), rng.integers(0, 400, 100_000)
    scorer.pairs(q, row[:1], d, col[:1])
    tracemalloc.start()
    found = scorer.pairs(q, row, d, col)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    np.testing.assert_allclose(found, scorer.score(q, 0, 50, d)[row, col], rtol=0, atol=1e-9)
    assert peak < 20 << 20
