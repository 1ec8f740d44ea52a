"""One query per operator, over whole tables, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from negsift.llm import (
    attribution, bagrank, chat, hmm, importance, maxscore, mixing, packing, rules, shard, simhash, sql, sumsquares, warc,
)
from negsift.llm.catalog import ORACLES, QUERIES, query, table
from negsift.session import stored

SHARDS = 40
DIMENSIONS = ["lang", "source", "n_chars", "doc_id"]
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query()
def op1_kd_shards(spark, sf):
    rows = shard.shard(table(spark, sf, "documents"), DIMENSIONS, shards=SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op2_hmm_scores(spark, sf):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return hmm.score(table(spark, sf, "documents"), held_out)


@query()
def op3_soft_mixing(spark, sf):
    """Posteriors of the domains, and rate and copies of each document."""
    labels = mixing.labelled(table(spark, sf, "labels"))
    found = mixing.mixed(table(spark, sf, "documents"), labels, [mixing.TARGETS[d] for d in mixing.DOMAINS])
    shares = [F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)]
    return found.select("doc_id", "tokens", *shares, "rate", mixing.copies(F.col("rate"), F.col("key")).alias("copies"))


@query(sql.TOPK)
def op4_maxscore(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return maxscore.topk(vectors, F.col("vec_id") % 20 == 0).withColumnRenamed("id", "vec_id")


@query(sql.RULES)
def op5_quality_cascade(spark, sf):
    """The measures asked for are columns; lines and capitals are computed by the rules, for texts that come that far."""
    texts = table(spark, sf, "documents").select("doc_id", "text")
    found = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    docs = rules.with_measures(texts, names=list(found))
    sample = stored(rules.with_measures(rules.sample_of(texts, 1000), names=list(found)), "measured")
    few, repeated = rules.RULES[0].rejects(found), rules.RULES[1].rejects(found)
    judged = rules.cascade(docs, found=found, sample=sample)
    return judged.select("doc_id", *found, (few | repeated).alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


@query()
def op6_token_attribution(spark, sf):
    """Tokens of the source, the language and each line of the text of every document."""
    return attribution.attribute(table(spark, sf, "documents"), ["source", "lang", "text"], by_line={"text"})


@query(sql.CHAT)
def op7_chat_masks(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(CONTROL)
    )
    return chat.round_trip(turns.union(own))


@query(sql.REVISITS)
def op8_warc_revisits(spark, sf):
    read = warc.round_trip(table(spark, sf, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_simhash_groups(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"), width=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op10_best_fit(spark, sf):
    return packing.pack(table(spark, sf, "documents")).drop("ids")


@query(sql.RANKED)
def op11_bag_search(spark, sf):
    return bagrank.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 20)


@query(sql.RESAMPLED)
def op12_bit_sliced(spark, sf):
    found = importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_sum_of_squares(spark, sf):
    return sumsquares.pack(table(spark, sf, "documents")).drop("ids")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
