"""Three-table layout: corpus, queries and relevance judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from negsift.functions.docstrings import strip_docstrings as strip
from negsift.functions.text import title_and_text
from negsift.operators.dedup import dedup_bundle, resolve_id_conflicts
from negsift.schema import Bundle, KEYS


def _field(rows: DataFrame, name: str):
    return F.col(f"`{name}`") if name in rows.columns else F.lit(None).cast("string")


def beir_corpus(
    rows: DataFrame,
    id_field: str = "_id",
    text_field: str = "text",
    title_field: str = "title",
    strip_docstrings: bool = False,
) -> DataFrame:
    corpus = rows.select(
        *KEYS,
        F.col(f"`{id_field}`").cast("string").alias("document_id"),
        title_and_text(_field(rows, title_field), _field(rows, text_field)).alias("document"),
        "pos",
    ).filter(F.col("document") != "")
    if strip_docstrings:
        corpus = corpus.withColumn("document", strip(F.col("document"), F.col("lang"))["code"])
    return corpus


def beir_queries(rows: DataFrame, id_field: str = "_id", text_field: str = "text") -> DataFrame:
    return rows.select(
        *KEYS,
        F.col(f"`{id_field}`").cast("string").alias("query_id"),
        F.col(f"`{text_field}`").cast("string").alias("query"),
        "pos",
    ).filter(F.col("query") != "")


def beir_qrels(
    rows: DataFrame,
    query_id_field: str = "query-id",
    corpus_id_field: str = "corpus-id",
    score_field: str = "score",
) -> DataFrame:
    """Judgements above zero. Without a score column every judgement counts."""
    if score_field in rows.columns:
        rows = rows.filter(F.col(f"`{score_field}`").cast("double") > 0)
    return rows.select(
        *KEYS,
        F.col(f"`{query_id_field}`").cast("string").alias("query_id"),
        F.col(f"`{corpus_id_field}`").cast("string").alias("document_id"),
        "pos",
    )


def beir_bundle(
    corpus: DataFrame,
    queries: DataFrame,
    qrels: DataFrame,
    corpus_text_field: str = "text",
    corpus_id_field: str = "_id",
    queries_text_field: str = "text",
    queries_id_field: str = "_id",
    qrels_query_id_field: str = "query-id",
    qrels_corpus_id_field: str = "corpus-id",
    qrels_score_field: str = "score",
    strip_docstrings: bool = False,
    deduplicate_corpus: bool = False,
) -> Bundle:
    """The three tables as a bundle. Of rows that share an id the last one counts,
    in the corpus and among the queries: everything later takes an id for one text."""
    bundle = Bundle(
        resolve_id_conflicts(beir_queries(queries, queries_id_field, queries_text_field), id_col="query_id"),
        resolve_id_conflicts(beir_corpus(corpus, corpus_id_field, corpus_text_field, strip_docstrings=strip_docstrings)),
        beir_qrels(qrels, qrels_query_id_field, qrels_corpus_id_field, qrels_score_field),
    )
    return dedup_bundle(bundle) if deduplicate_corpus else bundle
