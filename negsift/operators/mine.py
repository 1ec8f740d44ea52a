"""From hits and judgements to positives and hard negatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from negsift.operators.order import numbered
from negsift.operators.skew import HOT_ROWS, hot_keys
from negsift.schema import KEYS, NOT_RETRIEVED
from negsift.session import stored

PAIR = [*KEYS, "query_id", "document_id"]
QUERY = [*KEYS, "query_id"]


def label_hits(hits: DataFrame, qrels: DataFrame) -> DataFrame:
    """Hits with ``is_pos``."""
    positive = qrels.select(*PAIR).distinct().withColumn("is_pos", F.lit(True))
    return hits.join(positive, PAIR, "left").fillna(False, ["is_pos"])


def missing_positives(hits: DataFrame, qrels: DataFrame) -> DataFrame:
    """Positives that retrieval did not return, scored -1."""
    return (
        qrels.select(*PAIR).distinct().join(hits.select(*PAIR), PAIR, "left_anti")
        .withColumn("score", F.lit(NOT_RETRIEVED))
    )


def mined_entries(
    queries: DataFrame,
    hits: DataFrame,
    qrels: DataFrame,
    num_negatives: int = 100,
    metric: str = "cosine",
    l2_parity: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The long form of the mining result, one row per list entry.

    ``place`` counts from 1: retrieved positives by rank, then unretrieved ones
    by id with score -1, then the best ``num_negatives`` negatives. A query
    without any positive has no rows; one with positives but no hits has them.

    Hits and judgements meet in one exchange on the query: they are stacked, the
    rows of a pair are merged, and the same partitioning then serves the ranking. Queries
    with ``hot_rows`` judgements or more are ranked apart, by ranges and not by query, so that
    they are as many tasks as they need.
    """
    hot = hot_keys(qrels, QUERY, hot_rows).collect()
    if hot:
        hits = stored(hits, "hits")
        names = F.broadcast(qrels.sparkSession.createDataFrame([tuple(r) for r in hot], "dataset string, lang string, query_id string"))
        cold = [rows.join(names, QUERY, "left_anti") for rows in (hits, qrels)]
        some = [rows.join(names, QUERY, "left_semi") for rows in (hits, qrels)]
        options = (num_negatives, metric, l2_parity)
        return _entries(queries, *cold, *options, apart=False).unionByName(_entries(queries, *some, *options, apart=True))
    return _entries(queries, hits, qrels, num_negatives, metric, l2_parity, apart=False)


def _entries(
    queries: DataFrame, hits: DataFrame, qrels: DataFrame, num_negatives: int, metric: str, l2_parity: bool, apart: bool
) -> DataFrame:
    """``apart``: by sorting all rows together, for few queries of many rows each."""
    wanted = qrels.join(queries.select(*QUERY), QUERY, "left_semi")
    none = F.lit(None)
    stacked = hits.select(*PAIR, "score", "rank", F.lit(False).alias("judged")).unionByName(
        wanted.select(*PAIR, none.cast("double").alias("score"), none.cast("int").alias("rank"), F.lit(True).alias("judged"))
    )
    merged = (
        (stacked if apart else stacked.repartition(*QUERY))
        .groupBy(*PAIR)
        .agg(F.max("score").alias("score"), F.min("rank").alias("rank"), F.max("judged").alias("is_pos"))
    )
    farthest_first = metric == "l2" and l2_parity
    part = F.when(F.col("is_pos") & F.col("rank").isNotNull(), 0).when(F.col("is_pos"), 1).otherwise(2)
    negative_order = F.when(~F.col("is_pos"), -F.col("score") if farthest_first else F.lit(0.0))
    of_query = W.partitionBy(*QUERY)
    order = [part, negative_order, F.col("rank"), F.col("document_id")]
    if apart:
        ranked = numbered(merged, [*map(F.col, QUERY), *order], "_number")
        # A row per query, and these are few.
        of = ranked.groupBy(*QUERY).agg(F.min("_number").alias("_first"), F.count_if("is_pos").alias("positives"))
        ranked = ranked.join(F.broadcast(of), QUERY).withColumn("place", (F.col("_number") - F.col("_first") + 1).cast("int"))
    else:
        ranked = merged.withColumn("place", F.row_number().over(of_query.orderBy(*order))).withColumn("positives", F.count_if("is_pos").over(of_query))
    return (
        ranked.filter((F.col("positives") > 0) & (F.col("place") - F.col("positives") <= num_negatives))
        .select(
            *PAIR,
            "place",
            F.coalesce("score", F.lit(NOT_RETRIEVED)).alias("score"),
            "is_pos",
            F.col("rank").isNotNull().alias("retrieved"),
            "positives",
        )
    )


def negatives(entries: DataFrame) -> DataFrame:
    """The hard negatives of each query with their ordinal from 1."""
    return entries.filter(~F.col("is_pos")).select(
        *PAIR, "score", (F.col("place") - F.col("positives")).cast("int").alias("neg_rank")
    )


def skipped_queries(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """Queries without any positive."""
    return queries.join(qrels.select(*QUERY).distinct(), QUERY, "left_anti")


def mining_report(queries: DataFrame, entries: DataFrame, available: DataFrame | None = None) -> DataFrame:
    """Per bundle: queries, skipped queries, results, positives not retrieved.

    ``available`` are the queries before sampling; then ``queries_available`` says how
    many there were.
    """
    asked = queries.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("queries"))
    mined = entries.groupBy(*KEYS).agg(
        F.count_if(F.col("place") == 1).alias("results"),
        F.count_if(F.col("is_pos") & ~F.col("retrieved")).alias("positives_not_retrieved"),
    )
    if available is not None:
        asked = available.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("queries_available")).join(asked, KEYS, "left")
    return (
        asked.join(mined, KEYS, "left")
        .fillna(0, ["queries", "results", "positives_not_retrieved"])
        .withColumn("skipped", F.col("queries") - F.col("results"))
    )
