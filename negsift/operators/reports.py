"""Counters of the loading step."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from negsift.functions.docstrings import strip_docstrings
from negsift.operators.spread import spread_small
from negsift.schema import Bundle, KEYS


def load_report(bundle: Bundle) -> DataFrame:
    """Per bundle: queries, documents and queries with at least one judgement.

    The three tables are counted apart and their counts stacked; joining them
    would drop a bundle that lacks one.
    """

    def counted(rows: DataFrame, column: str) -> DataFrame:
        zero = {c: F.lit(0).cast("long") for c in ("queries", "documents", "judged_queries")}
        zero[column] = F.count(F.lit(1))
        return rows.groupBy(*KEYS).agg(*[value.alias(c) if c == column else F.first(value).alias(c) for c, value in zero.items()])

    judged = bundle.qrels.select(*KEYS, "query_id").distinct()
    parts = (
        counted(bundle.queries, "queries")
        .unionByName(counted(bundle.corpus, "documents"))
        .unionByName(counted(judged, "judged_queries"))
    )
    return parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("queries", "documents", "judged_queries")])


def docstring_report(corpus: DataFrame) -> DataFrame:
    """Per bundle: documents parsed, changed and failed by the docstring step."""
    status = spread_small(corpus).select(*KEYS, strip_docstrings(F.col("document"), F.col("lang"))["status"].alias("status"))
    return status.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("status").isin("parsed", "changed")).alias("parsed"),
        F.count_if(F.col("status") == "changed").alias("changed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
