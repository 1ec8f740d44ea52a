import hashlib

from pyspark.sql import functions as F

from negsift.operators.sample import qrels_of, sample, sample_queries
from rows import as_set, qrels, queries


def _brute(ids, n, seed):
    return set(sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))[:n])


def test_exact_and_repartition_proof(spark):
    ids = [f"q{i}" for i in range(500)]
    rows = queries(spark, ids)
    for n in (1, 7, 250, 499):
        want = {(i,) for i in _brute(ids, n, 42)}
        assert as_set(sample_queries(rows, n), "query_id") == want
        assert as_set(sample_queries(rows.repartition(13), n), "query_id") == want
    assert as_set(sample_queries(rows, 20, 1), "query_id") != as_set(sample_queries(rows, 20, 2), "query_id")


def test_full_slots(spark):
    """More rows than slots, so that a slot is cut in its middle."""
    rows = spark.range(300_000).select(F.lit("s").alias("dataset"), F.lit("x").alias("lang"), F.col("id").cast("string").alias("query_id"))
    got = as_set(sample(rows, 123_457, 42, "query_id"), "query_id")
    assert got == {(i,) for i in _brute([str(i) for i in range(300_000)], 123_457, 42)}


def test_no_limit(spark):
    rows = queries(spark, ["a", "b"])
    assert sample_queries(rows, 0).count() == sample_queries(rows, None).count() == sample_queries(rows, 9).count() == 2


def test_per_language(spark):
    rows = queries(spark, [f"q{i}" for i in range(30)], "x").unionByName(queries(spark, [f"q{i}" for i in range(5)], "y"))
    assert {r["lang"]: r["count"] for r in sample_queries(rows, 10).groupBy("lang").count().collect()} == {"x": 10, "y": 5}


def test_judgements_follow(spark):
    judged = qrels(spark, [("a", "d1"), ("b", "d2"), ("c", "d3")])
    assert as_set(qrels_of(judged, queries(spark, ["a", "c"])), "query_id") == {("a",), ("c",)}
