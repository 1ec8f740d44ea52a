"""The language model: forward against all paths, counts and base against plain Python."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.llm import hmm as H
from negsift.llm.catalog import table


def model(states=3, symbols=5, seed=2):
    rng = np.random.default_rng(seed)
    share = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    return H.Model(share(rng.random(states), 0), share(rng.random((states, states)), 1), share(rng.random((symbols, states)), 0))


def all_paths(m, seq):
    """Likelihood, and expected starts, steps and emissions, by every path."""
    k = len(m.start)
    total, starts, steps, emits = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros(m.emit.shape)
    for path in itertools.product(range(k), repeat=len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for a, b, s in zip(path, path[1:], seq[1:]):
            p *= m.step[a, b] * m.emit[s, b]
        total += p
        starts[path[0]] += p
        for a, b in zip(path, path[1:]):
            steps[a, b] += p
        for s, state in zip(seq, path):
            emits[s, state] += p
    return total, starts / total, steps / total, emits / total


def sequences(seqs):
    sizes = np.array([len(s) for s in seqs], np.int64)
    return H.Sequences(np.concatenate(seqs), np.cumsum(sizes) - sizes, sizes)


SEQS = [np.array(s) for s in ([0, 1, 2], [4], [3, 3, 1, 0, 2, 4], [2, 2])]


def test_forward_sums_all_paths():
    m = model()
    got = H.forward(m, sequences(SEQS))
    assert np.allclose(got, [math.log10(all_paths(m, s)[0]) for s in SEQS])
    assert np.allclose([H.likelihood(m, s, step=2) for s in SEQS], got)


def test_expected_counts_sum_all_paths():
    m = model()
    starts, steps, emits, logs = H.expect(m, sequences(SEQS), 5)
    want = [all_paths(m, s) for s in SEQS]
    assert np.allclose(starts, sum(w[1] for w in want), atol=1e-4)
    assert np.allclose(steps, sum(w[2] for w in want), atol=1e-4)
    assert np.allclose(emits, sum(w[3] for w in want), atol=1e-4)
    assert logs == pytest.approx(sum(math.log10(w[0]) for w in want), abs=1e-4)


def plain(docs, held):
    """(n_tokens, n_known, base) by id, and N."""
    own = {i: H.tokens(t) for i, t in docs}
    counts = Counter(w for i, words in own.items() if not held(i) for w in words)
    total, distinct = sum(counts.values()), len(counts)
    base = {i: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words) for i, words in own.items()}
    return {i: (len(w), sum(counts[x] > 0 for x in w), base[i]) for i, w in own.items()}, total


@pytest.mark.parametrize("frequent", [None, 200])
def test_base_and_counts(spark, sf, monkeypatch, frequent):
    if frequent:  # most words take the way of the rare ones
        monkeypatch.setattr(H, "FREQUENT", frequent)
        monkeypatch.setattr(H, "SYMBOLS", 10)
    docs = table(spark, sf, "documents").limit(200)
    rows = docs.select("doc_id", "text").collect()
    want, total = plain([(r[0], r[1]) for r in rows], lambda i: zlib.crc32(str(i).encode()) % 10 == 0)
    got = H.score(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0, rounds=2).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_words_and_unseen_share_one(spark, monkeypatch):
    """Given a bucket, the shares of its words and of unseen words sum to 1."""
    docs = spark.createDataFrame([(i, f"a b{i % 7} c{i % 5} d") for i in range(40)], "doc_id long, text string")
    monkeypatch.setattr(H, "SYMBOLS", 3)
    words = H.counts(docs, "text").cache()
    known = H.vocabulary(words)
    share = Counter()
    for r in words.collect():
        if known.frequent[bytes(r["word"])] >= known.symbols:
            share[H.bucket_of(r["word"])] += (r["many"] + 0.1) / 10 ** known.buckets[H.bucket_of(r["word"])]
    for bucket in range(H.BUCKETS):
        assert share[bucket] + 0.1 / 10 ** known.buckets[bucket] == pytest.approx(1)


def test_training_helps(spark, sf):
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    sums = H.score(table(spark, sf, "documents"), held).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] > sums[1] + 0.1 * sums[2]


def test_likelihood_grows(spark):
    rng = np.random.default_rng(3)
    rows = [([int(x) for x in rng.integers(0, 6, 30) + 6 * (i % 2)],) for i in range(40)]
    texts = spark.createDataFrame(rows, "symbols array<int>")
    _, history = H.train(texts, 12, np.ones(12), states=2, rounds=6)
    # Up to the prior's pull, which is small beside 1,200 tokens.
    assert history[-1] > history[0] and all(b > a - 1 for a, b in zip(history, history[1:]))


def test_odd_rows(odd, nothing):
    held = F.col("doc_id") == 1
    rows = H.score(odd, held, rounds=1).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert H.score(nothing, held, rounds=1).collect() == []


def test_all_held_out(odd):
    rows = H.score(odd, F.lit(True), rounds=1).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == pytest.approx(r["n_tokens"] * 0.0) for r in rows)
