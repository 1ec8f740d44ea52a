"""What a search makes and writes besides its hits."""

from pyspark.sql import functions as F

from negsift.operators import encode, retrieve as r, topk
from tests.rows import corpus, queries


def test_size_is_measured_on_few_rows(spark):
    """Of many partitions, not as many rows each are made and shuffled."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def made(i):
        seen.add(1)
        return [float(i)] * 8

    rows = spark.range(0, 40_000, 1, 40).withColumn("embedding", made("id"))
    assert topk.measured_bytes(rows, 100) == (100 * (8 + 32), 100)
    assert seen.value <= 1_000  # a partition
    assert topk.measured_bytes(rows.limit(3), 100)[1] == 3
    assert topk.measured_bytes(rows.limit(0)) == (0, 0)


def test_exact_late_search_stores_no_tokens_of_documents(spark, monkeypatch):
    """Token vectors are far larger than texts: they are made where they are scored, and those of the floors' part again."""
    texts = {f"d{i}": f"w{i} w{i % 7} w{i % 11}" for i in range(200)}
    asked = queries(spark, ["w1", "w9"]).withColumn("query", F.concat(F.lit("w3 "), "query_id"))
    names, write = [], r.stored
    monkeypatch.setattr(r, "stored", lambda rows, name, by=None: names.append(name) or write(rows, name, by))
    coder, options = encode.hashed_token_encoder(), {"pruned": False}
    found = r.retrieve(asked, corpus(spark, texts), 5, "late_interaction", coder, **options)
    floors = r.retrieve(asked, corpus(spark, texts), 5, "late_interaction", coder, floor_rows=1, floor_share=3, **options)
    assert names == ["query-vectors"] * 2
    rows = sorted(map(tuple, found.collect()))
    assert len(rows) == 10 and rows == sorted(map(tuple, floors.collect()))
