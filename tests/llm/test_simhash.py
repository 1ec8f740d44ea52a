"""SimHash groups against fingerprints by the definition and all pairs of them."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from negsift.llm import simhash as S
from negsift.llm.catalog import table
from negsift.llm.components import components


def by_definition(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def brute(rows, width):
    """component_id by (id, text) row."""
    prints = [by_definition(t, width) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    of = groups(links)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[of[i]] = min(doc, least.get(of[i], doc))
    return [(doc, p, least.get(of[i])) for i, ((doc, _), p) in enumerate(zip(rows, prints))]


def collected(df):
    return sorted(((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("width", [3, 5])
def test_documents(spark, sf, width):
    docs = table(spark, sf, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert collected(S.near_duplicates(docs, width=width)) == sorted(brute(rows, width), key=str)


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert collected(S.near_duplicates(odd, width=3)) == sorted(brute(rows, 3), key=str)
    assert S.near_duplicates(nothing).collect() == []


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.integers(0, 63), st.integers(0, 63))
def test_close_fingerprints_meet(x, i, j):
    y = x ^ (1 << i) ^ (1 << j)
    row, anchor, home = S.anchors(np.array([signed(x), signed(y)], np.int64))
    assert set(anchor[(row == 0) & home]) & set(anchor[row == 1])
    assert set(anchor[(row == 1) & home]) & set(anchor[row == 0])


def test_links_of_dense_groups(spark):
    rng = random.Random(4)
    points = {0, 2**64 - 1}
    for _ in range(12):  # a centre, and many around it
        centre = rng.getrandbits(64)
        for _ in range(80):
            points.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    points = sorted(points)
    links = S.links(spark.createDataFrame([(signed(p),) for p in points], "fp long")).collect()
    close = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 2
    assert all(close(r["a"], r["b"]) for r in links) or links  # a link may be by way of others
    want = groups([(signed(a), signed(b)) for a in points for b in points if close(a, b)])
    got = groups([(signed(p), signed(p)) for p in points] + [(r["a"], r["b"]) for r in links])
    assert got == want
    assert len(links) < 40 * len(points)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    star = [(5000, i) for i in range(5001, 5200)]
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges = chain + star + pairs + [(7, 7), (None, 3)]
    rng.shuffle(edges)
    want = groups([e for e in edges if None not in e])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: r for n, r in want.items() if n != r}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark, odd, nothing):
    kept = S.keep_one(odd, width=3)
    assert kept.columns == odd.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    prints = [by_definition(t, 3) for _, t in rows]
    of = groups([(i, j) for i in range(len(rows)) for j in range(i + 1) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    members = {}
    for i, row in enumerate(rows):
        members.setdefault(of[i], []).append(row)
    assert len(got) == len(members)
    for group in members.values():
        least = min((doc for doc, _ in group if doc is not None), default=None)
        assert sum(row in group for row in got) == 1 and any(row in group and row[0] == least for row in got)
    assert S.keep_one(nothing).collect() == []
