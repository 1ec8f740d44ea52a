"""Toxic documents of every language are told that the classifier was not shown."""

import os

from pyspark.sql import functions as F

from negsift.llm import mixing as M
from negsift.llm.catalog import table


def test_held_out_toxic_documents_per_language(spark, sf):
    large = os.path.join(os.path.dirname(sf), "sf0.1")
    docs, labels = table(spark, large, "documents"), M.labelled(table(spark, large, "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    weights = M.classifier(docs, labels.filter(~fold))
    rows = M.posteriors(docs.join(labels.filter(fold).select("doc_id"), "doc_id"), weights)
    rows = rows.join(labels.filter(fold), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    toxic = (F.get("p", F.lit(1)) + F.get("p", F.lit(3)) > 0.5).cast("int").alias("told")
    rows = rows.select("lang", "toxic", toxic).collect()
    by = {}
    for r in rows:
        if r["toxic"]:
            by.setdefault(r["lang"], []).append(r["told"])
    clean = [r["told"] for r in rows if not r["toxic"]]
    assert all(sum(v) >= 0.8 * len(v) for v in by.values())
    assert sum(map(sum, by.values())) >= 0.9 * sum(map(len, by.values()))
    assert sum(clean) <= 0.02 * len(clean)


def test_a_word_between_symbols_counts_once(spark):
    found = spark.createDataFrame([('Fool "fool," a!', ), ("(fool) a! --",), (None,)], "text string").select(M.features(F.col("text"))).collect()
    assert sorted(found[0][0]) == sorted(["fool", '"fool,"', "a!", " ends l", ' ends "', " ends !", " bare a", M._BIAS])
    assert sorted(f for f in found[1][0] if f.startswith(M._BARE)) == [M._BARE, M._BARE + "a", M._BARE + "fool"]
    assert found[2][0] == [M._BIAS]


def test_features_met_in_place_are_those_met_by_name(spark, sf, odd):
    docs = table(spark, sf, "documents")
    known = [w["feature"] for w in M.classifier(docs, M.labelled(table(spark, sf, "labels")))]
    known += [M._BARE + "a", "a!", M._ENDING + "!", M._ENDING + "1", M._ENDING + ")", M._ENDING + ".", "漢字"]
    known = list(dict.fromkeys(known))
    more = [(t,) for t in ["", None, "x ends with a.\n", "a (a) \"a\" a!", "!!! ... «a» ¿a?", "1", "end)\x0b", "漢字 “漢字”"]]
    texts = docs.select("text").union(odd.select("text")).union(spark.createDataFrame(more, "text string"))
    rows = texts.withColumn("plain", F.array_distinct(M.words_of(F.lower("text"))))
    text = F.coalesce("text", F.lit(""))
    rows = rows.select(M.features(text).alias("all"), M._met(F.col("plain"), text, known).alias("met")).collect()
    for r in rows:
        assert len(set(r["met"])) == len(r["met"]) and set(r["met"]) == set(r["all"]) & set(known)
