"""Bag search: scores and ranks by definition, classes of equal bags, any number of items."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from negsift.llm import bagrank as B
from negsift.llm.alnum import words
from negsift.llm.catalog import table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """Sorted rows ``(item place, rank, doc_id, score)``."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for place, text in enumerate(items):
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_terms
            s = 0
            for t in terms(text):
                if b[t]:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(place, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def asked(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def rows(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def test_words():
    text = "Ab_c-É9 ÀB\x7fx`y 漢字\x00Z\n  a b"
    assert [w.decode() for w in words(text.encode())] == terms(text)
    assert words(None) == words(b"") == words(b" _-\x00") == []


@pytest.mark.parametrize("block_bytes", [1 << 20, 1500])
def test_equals_brute_force(spark, sf, block_bytes):
    docs = table(spark, sf, "documents").filter("doc_id < 300")
    items = table(spark, sf, "benchmark")
    own = [(r["doc_id"], r["text"]) for r in docs.collect()]
    texts = [r["text"] for r in items.orderBy("item_id").collect()]
    want = brute(own, texts, 5)
    ids = [r["item_id"] for r in items.orderBy("item_id").collect()]
    assert rows(B.search(docs, items, 5, block_bytes=block_bytes)) == sorted((ids[p], r, d, s) for p, r, d, s in want)


def test_ties_copies_and_hot_classes(spark):
    """Two thirds of the rows are one bag in several orders of words; the smallest ids win."""
    docs = [(i, "b a" if i % 2 else "A, B!") for i in range(400, 0, -1)] + [(i, f"a c{i} d") for i in range(1000, 1200)]
    docs += [(None, "a b"), (7, "a b"), (3000, "zz")]
    items = ["a", "a a b", "c1003 d nothing", "zz zz", "", None, "unknown"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert rows(B.search(frame, asked(spark, items), 20)) == brute(docs, items, 20)


def test_small_matrices_and_integers(spark, monkeypatch):
    docs = [(i, " ".join(f"t{i * j % 11}" for j in range(i % 9))) for i in range(200)]
    items = [" ".join(f"t{j % (i + 2)}" for j in range(i + 1)) for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    whole = brute(docs, items, 4)
    for cells, held, exact in ((40, 10, 1 << 53), (1 << 22, 64, 0)):
        monkeypatch.setattr(B, "_CELLS", cells)
        monkeypatch.setattr(B, "_HELD", held)
        monkeypatch.setattr(B, "_EXACT", exact)
        # Tasks import the module anew, so the loop of a task is run here.
        of = B.Items([words(t.encode()) for t in items])
        assert sum(len(own) for own, *_ in of.slices()) == len(items)
        assert rows(B.search(frame, asked(spark, items), 4)) == whole


def test_string_ids(spark):
    docs = [("b", "x y"), ("a", "y x"), ("c", "x"), (None, "x y")]
    found = B.search(spark.createDataFrame(docs, "doc_id string, text string"), asked(spark, ["x", "y"]), 3).orderBy("item_id", "rank").collect()
    assert [(r["item_id"], r["doc_id"]) for r in found if r["item_id"] == 1] == [(1, "a"), (1, "b"), (1, None)]


def test_odd_rows(spark, odd, nothing):
    items = ["word3 id", "漢字 w5", "same", None, "w5 w5"]
    own = [(r["doc_id"], r["text"]) for r in odd.collect()]
    clashing = asked(spark, items).withColumns({c: F.lit("x") for c in ["doc_id", "rank", "score", "row", "n", "bag"]})
    assert rows(B.search(odd, clashing, 3)) == brute(own, items, 3)
    assert rows(B.search(nothing, clashing, 3)) == []
    assert rows(B.search(odd, asked(spark, items).limit(0), 3)) == []
    repeated = spark.createDataFrame([(None, "same"), (5, "same"), (5, "same")], "item_id long, text string")
    assert len(B.search(odd, repeated, 3).collect()) == 3 * len(brute(own, ["same"], 3))
