"""Sharding: near equal bytes, gapless slots, the tree against one built with all rows at hand."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from negsift.llm import shard as S
from negsift.llm.catalog import table

DIMS = ["lang", "source", "n_chars", "doc_id"]


def check_slots(rows):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_documents(spark, sf):
    docs = table(spark, sf, "documents")
    rows = S.shard(docs, DIMS, shards=40).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(rows) == len(texts)
    check_slots(rows)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    sizes = np.zeros(40)
    for r in rows:
        sizes[r["shard"]] += r["size"]
    # Each cut is off by less than one document.
    assert np.abs(sizes - sizes.mean()).max() < max(r["size"] for r in rows)


def brute(points, sizes, shards):
    """points: rows of (cell, tie) keys per dimension."""
    if shards == 1:
        return np.zeros(len(sizes), int)
    left = shards // 2
    cells = points // S.TIES
    dim = int(np.argmax(cells.max(axis=0) - cells.min(axis=0)))
    order = np.argsort(points[:, dim], kind="stable")
    up_to = np.cumsum(sizes[order])
    goal = up_to[-1] * left / shards
    at = int(np.argmax(up_to >= goal))
    before = up_to[at] - sizes[order[at]]
    many = at if goal - before <= up_to[at] - goal else at + 1
    out = np.zeros(len(sizes), int)
    first, second = order[:many], order[many:]
    out[first] = brute(points[first], sizes[first], left) if many else 0
    out[second] = left + (brute(points[second], sizes[second], shards - left) if many < len(order) else 0)
    return out


def test_tree_is_that_of_all_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(rng.integers(1, 400)), "en", f"s{int(rng.integers(0, 3))}", int(rng.integers(0, 9))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    grid, _, levels = S.plan(docs, DIMS, 7, None, "doc_id", "text")
    got = S.assign(grid, levels).select("doc_id", "_keys", "_size", "_node").orderBy("doc_id").collect()
    keys, sizes = np.array([r["_keys"] for r in got]), np.array([r["_size"] for r in got])
    assert [r["_node"] for r in got] == brute(keys, sizes, 7).tolist()


def test_one_value_in_a_third_of_the_rows(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t" * 50).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("source"))
    sizes = [r[0] for r in S.shard(docs, ["source"], shards=8).groupBy("shard").count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 4


def test_target_bytes(spark, sf):
    docs = table(spark, sf, "documents")
    total = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    assert S.shard(docs, DIMS, target_bytes=total // 9 + 1).select("shard").distinct().count() == 9


def test_odd_rows(odd):
    rows = S.shard(odd, DIMS, shards=3).collect()
    assert len(rows) == odd.count() and {r["shard"] for r in rows} <= {0, 1, 2}
    check_slots(rows)


def test_empty(nothing):
    assert S.shard(nothing, DIMS, shards=3).collect() == []


def test_written(spark, odd, tmp_path):
    S.write_shards(odd, f"file://{tmp_path}/out", DIMS, shards=2)
    back = spark.read.parquet(f"file://{tmp_path}/out")
    want = sorted(map(str, odd.select("doc_id", "text", "size").collect()))
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert len(want) == back.count() and "shard" in back.columns


def test_strings_that_share_a_prefix(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit("t" * 30).alias("text"), F.concat(F.lit("https://site"), F.col("id") % 4).alias("source")
    )
    rows = S.shard(docs, ["source"], shards=4).join(docs.select("doc_id", "source"), "doc_id")
    assert rows.select("shard", "source").distinct().count() == 4


def test_ranks(spark):
    values = ["b", "a", None, "é", "", "b", "B", "漢"]
    rows = spark.createDataFrame([(v,) for v in values], "_v0 string").repartition(5)
    found = {r["_v0"]: (r["many"], r["_rank"]) for r in S.value_ranks(rows, "_v0").collect()}
    order = sorted({v for v in values if v is not None}, key=lambda v: v.encode())
    assert found == {v: (values.count(v), float(i)) for i, v in enumerate(order)}
    many = spark.range(30_000).select(F.md5(F.col("id").cast("string")).alias("_v0"))
    got = S.value_ranks(many, "_v0").orderBy("_v0").collect()
    assert [r["_rank"] for r in got] == [float(i) for i in range(30_000)]


def test_one_row_repeated(spark):
    """A third of the rows are equal in everything; the law of equal bytes holds all the same."""
    docs = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("doc_id"), F.lit("t" * 50).alias("text"), F.lit("s").alias("source"))
    rows = S.shard(docs, ["source", "doc_id"], shards=40).collect()
    sizes = np.bincount([r["shard"] for r in rows], minlength=40)
    check_slots(rows)
    assert len(rows) == 3000 and sizes.max() - sizes.min() <= 4
