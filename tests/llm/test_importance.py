"""Resampling: exact weights against plain sums, ranks by definition."""

import hashlib
import math
from collections import Counter
from zlib import crc32

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from negsift.llm import importance as I
from test_bagrank import terms


def runs(text):
    w = terms(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def buckets(text):
    return Counter(crc32(f.encode()) % 10_000 for f in runs(text))


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s += buckets(text)
    for text in target:
        t += buckets(text)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for doc, text in docs:
        weight = sum(n * gain(b) for b, n in buckets(text).items())
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(runs(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(terms(text))])
    part = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(part[: 5 * len(part) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(found):
    return sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(-(1 << 40), 1 << 40)), min_size=1, max_size=200))
def test_bit_slices_add_up(pairs):
    counts, of = (np.array(x, np.int64) for x in zip(*pairs))
    assert I.Gains(of).weight(counts) == sum(int(a) * int(b) for a, b in pairs)


def test_zero_planes():
    assert I.Gains(np.zeros(70, np.int64)).weight(np.ones(70, np.int64)) == 0
    assert I.Gains(np.ones(70, np.int64)).weight(np.zeros(70, np.int64)) == 0


def test_counts_over_chunks(monkeypatch):
    found = [f"w{i % 37}".encode() for i in range(1000)]
    whole = I.bucket_counts(found, 10_000)
    for chunk in (1, 2, 3, 7, 998, 999, 1000):
        monkeypatch.setattr(I, "_CHUNK", chunk)
        assert (I.bucket_counts(found, 10_000) == whole).all()
    assert whole.sum() == I.features(1000) == 2997
    assert [I.features(n) for n in range(4)] == [0, 1, 3, 6]


def test_repeated_rows_and_equal_scores(spark):
    """A third of all rows is one row; ranks stay gapless."""
    text = " ".join(f"word{i}" for i in range(25))
    docs = [(1, text)] * 200 + [(i, f"{text} extra{i % 5}") for i in range(2, 300)] + [(i, "few words") for i in range(300, 400)] + [(None, text)] * 3
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(text,), (None,)], "text string")
    found = got(I.resample(frame, target))
    want = brute(docs, [text])
    assert Counter(r[:4] for r in found) == Counter(r[:4] for r in want)
    ranks = {r[4]: r[3] for r in found if r[4]}
    assert sorted(ranks) == list(range(1, 5 * 501 // 100 + 1))
    assert [ranks[i] for i in sorted(ranks)] == sorted(ranks.values(), reverse=True)
    assert {(r[0], r[3], r[4]) for r in found if r[4]} == {(r[0], r[3], r[4]) for r in want if r[4]}


def test_odd_rows(spark, odd, nothing):
    target = spark.createDataFrame([("word3 word4 id other", "x"), ("", "x")], "text string, doc_id string")
    own = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(I.resample(odd, target)) == brute(own, ["word3 word4 id other", ""])
    assert got(I.resample(odd, target.limit(0))) == brute(own, [])
    assert got(I.resample(nothing, target)) == []
    assert got(I.resample(odd.withColumn("doc_id", F.lit(None).cast("long")), target))[0][0] is None
