"""Endings of words are looked up from the words, in one pass for all of them."""

from pyspark.sql import functions as F

from negsift.llm import mixing as M
from negsift.llm.frames import words

TEXTS = ["Stop! now", "a,\tb,  c", "", None, "no. \n", "x)\x0b|y", "ends with é", "ΑΣ σ", "one two!", "a(b [ ^"]
KNOWN = [" ", "now", *[M._ENDING + c for c in "!,.|)é(^[σzΣ"]]


def test_endings_are_those_of_the_features(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string").withColumn("text", F.coalesce("text", F.lit("")))
    plain = F.array_distinct(words(F.lower(F.col("text"))))
    for r in rows.select("text", M.features(F.col("text")).alias("all"), M._met(plain, F.col("text"), KNOWN).alias("met")).collect():
        assert sorted(r["met"]) == sorted(f for f in r["all"] if f in KNOWN), r["text"]


def test_no_ending_costs_a_search_of_the_text(spark):
    docs = spark.createDataFrame([(1, "Stop! now")], "doc_id long, text string")
    found = M.posteriors(docs, [{"feature": f, "w": [0.1, 0.2]} for f in KNOWN])
    assert "rlike" not in found._jdf.queryExecution().toString().lower()
