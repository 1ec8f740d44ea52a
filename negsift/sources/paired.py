"""Paired rows: each row holds a query and its correct document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from negsift.functions.docstrings import strip_docstrings
from negsift.operators.dedup import dedup_bundle
from negsift.schema import Bundle, KEYS


def _positional_id(prefix: str) -> Column:
    return F.concat_ws("_", F.lit(prefix), "lang", F.col("pos").cast("string"))


def valid_pairs(rows: DataFrame, query_field: str, documents_field: str, strip: bool = False) -> DataFrame:
    """Rows with a query and a document, named and numbered.

    Ids use the source position, which counts the dropped rows too, so that ids
    have gaps and do not depend on the filter.
    """
    query, document = F.col(f"`{query_field}`").cast("string"), F.col(f"`{documents_field}`").cast("string")
    pairs = rows.select(*KEYS, "pos", query.alias("query"), document.alias("document")).filter(
        (F.col("query") != "") & (F.col("document") != "")
    )
    if strip:
        pairs = pairs.withColumn("document", strip_docstrings(F.col("document"), F.col("lang"))["code"])
    return pairs.withColumn("query_id", _positional_id("q")).withColumn("document_id", _positional_id("d"))


def paired_bundle(
    rows: DataFrame,
    query_field: str,
    documents_field: str,
    strip_docstrings: bool = False,
    deduplicate_corpus: bool = False,
) -> Bundle:
    """Queries, corpus and 1:1 qrels of paired rows with dataset, lang and pos."""
    pairs = valid_pairs(rows, query_field, documents_field, strip_docstrings)
    bundle = Bundle(
        pairs.select(*KEYS, "query_id", "query", "pos"),
        pairs.select(*KEYS, "document_id", "document", "pos"),
        # The text columns are still needed by the validity filter, but the
        # docstring step is not, so qrels never visit the Python worker.
        valid_pairs(rows, query_field, documents_field).select(*KEYS, "query_id", "document_id", "pos"),
    )
    return dedup_bundle(bundle) if deduplicate_corpus else bundle
