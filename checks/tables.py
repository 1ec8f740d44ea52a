"""Bundles made of the given tables. Each uses whole tables and whole texts.

vec   every row of ``embeddings`` is a query and a document; correct are the
      document of the same row and the first one of its label
chat  ``conversations`` as paired rows: a user turn and the assistant turn after it
beir  corpus ``documents``, queries ``benchmark``, correct is a document that
      contains the text of the query
dup   ``documents`` by language
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from negsift.schema import Bundle, KEYS
from negsift.session import scratch_path
from negsift.sources.beir import beir_bundle
from negsift.sources.positions import read_with_pos


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bundle_columns(rows: DataFrame, dataset: str, lang) -> DataFrame:
    return rows.withColumns({"dataset": F.lit(dataset), "lang": lang if not isinstance(lang, str) else F.lit(lang)})


def vec(spark: SparkSession, sf: str) -> Bundle:
    rows = bundle_columns(table(spark, sf, "embeddings"), "vec", "mixed")
    queries = rows.select(
        *KEYS, F.concat(F.lit("q"), "vec_id").alias("query_id"), "embedding", F.col("vec_id").alias("pos"),
        F.concat(F.lit("query "), "vec_id").alias("query"),
    )
    corpus = rows.select(
        *KEYS, F.concat(F.lit("d"), "vec_id").alias("document_id"), "embedding", F.col("vec_id").alias("pos"),
        F.concat(F.lit("document "), "vec_id").alias("document"),
    )
    # One row per label: found with a combined aggregate and matched by broadcast.
    firsts = rows.groupBy("label").agg(F.min("vec_id").alias("first_id"))
    own = rows.select(*KEYS, "vec_id", F.col("vec_id").alias("doc"), (F.col("vec_id") * 2).alias("pos"))
    first = rows.join(firsts, "label").select(
        *KEYS, "vec_id", F.col("first_id").alias("doc"), (F.col("vec_id") * 2 + 1).alias("pos")
    )
    qrels = own.unionByName(first).select(
        *KEYS, F.concat(F.lit("q"), "vec_id").alias("query_id"), F.concat(F.lit("d"), "doc").alias("document_id"), "pos"
    )
    return Bundle(queries, corpus, qrels)


def vec_tokens(spark: SparkSession, sf: str) -> Bundle:
    from negsift.operators.encode import token_matrix

    queries, corpus, qrels = vec(spark, sf)
    return Bundle(token_matrix(queries, 4, 16), token_matrix(corpus, 4, 16), qrels)


def beir_texts(spark: SparkSession, sf: str) -> Bundle:
    """Plain texts of the same two tables, without judgements."""
    queries = bundle_columns(table(spark, sf, "benchmark"), "beir/Bench", "mixed").select(
        *KEYS, F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"), F.col("item_id").alias("pos")
    )
    corpus = bundle_columns(table(spark, sf, "documents"), "beir/Bench", "mixed").select(
        "dataset", F.lit("mixed").alias("lang"), F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("document"),
        F.col("doc_id").alias("pos"),
    )
    return Bundle(queries, corpus, queries.limit(0))


def chat_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn is a source row; only a user turn followed by an assistant turn
    has both fields, so the pair filter drops the others and ids have gaps."""
    turns = read_with_pos(spark, f"{sf}/conversations.parquet")
    answers = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"), F.lit("user").alias("role")
    )
    joined = turns.join(answers, ["conv_id", "turn", "role"], "left")
    return bundle_columns(joined, "chat/Turns", "mixed").withColumnRenamed("text", "instruction")


def beir_corpus_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("_id"), "text", F.when(F.col("lang") != "en", F.col("source")).alias("title"),
        F.col("doc_id").alias("pos"),
    )
    return bundle_columns(rows, "beir/Bench", "mixed")


def beir_query_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "benchmark").select(F.col("item_id").alias("_id"), "text", F.col("item_id").alias("pos"))
    return bundle_columns(rows, "beir/Bench", "mixed")


_KEPT: dict[tuple[str, str], str] = {}


def containing(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a benchmark item and a document that contains it, found once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _KEPT:
        path = scratch_path(spark, "containing")
        _containing(spark, sf).write.parquet(path)
        _KEPT[key] = path
    return spark.read.parquet(_KEPT[key])


def _containing(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a benchmark item and a document that contains it.

    Whatever contains a text contains its inner words as whole words, so the two
    tables meet on the longest inner word of each item. Words travel with ids
    only; the texts join the few pairs that are left, and are compared in whole.
    """
    words = lambda c: F.split(c, " ")
    documents, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    inner = F.slice(words("text"), 2, F.size(words("text")) - 2)
    longest = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    anchor = F.coalesce(longest, F.raise_error(F.lit("a benchmark item needs three words")).cast("string"))
    anchors = items.select("item_id", anchor.alias("word"))
    held = documents.select("doc_id", F.explode(F.array_distinct(words("text"))).alias("word"))
    return (
        held.join(anchors, "word")
        .select("item_id", "doc_id")
        .join(items.select("item_id", F.col("text").alias("item")), "item_id")
        .join(documents.select("doc_id", "text"), "doc_id")
        .filter(F.contains("text", F.col("item")))
        .select("item_id", "doc_id")
    )


def beir_qrel_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Judgements with a score: 1, and 0 for documents marked as toxic."""
    toxic = table(spark, sf, "labels").select("doc_id", "toxic")
    rows = containing(spark, sf).join(toxic, "doc_id", "left").select(
        F.col("item_id").alias("query-id"),
        F.col("doc_id").alias("corpus-id"),
        (1 - F.coalesce("toxic", F.lit(0))).alias("score"),
        (F.col("item_id") * 1_000_000_000 + F.col("doc_id")).alias("pos"),
    )
    return bundle_columns(rows, "beir/Bench", "mixed")


def beir(spark: SparkSession, sf: str, deduplicate_corpus: bool = False) -> Bundle:
    return beir_bundle(
        beir_corpus_rows(spark, sf),
        beir_query_rows(spark, sf),
        beir_qrel_rows(spark, sf),
        deduplicate_corpus=deduplicate_corpus,
    )


def dup_corpus(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(
        "lang", F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("document"), F.col("doc_id").alias("pos")
    )
    return rows.select(F.lit("docs").alias("dataset"), "*")


def dup_qrels(spark: SparkSession, sf: str) -> DataFrame:
    """Queries are the sources of documents; a source's documents are correct."""
    return table(spark, sf, "documents").select(
        F.lit("docs").alias("dataset"), "lang", F.col("source").alias("query_id"),
        F.col("doc_id").cast("string").alias("document_id"), F.col("doc_id").alias("pos"),
    )
