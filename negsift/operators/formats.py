"""The two output datasets: knowledge distillation (KD) and contrastive rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from negsift.operators.mine import PAIR, QUERY
from negsift.operators.positions import by_position
from negsift.operators.sample import sample
from negsift.operators.skew import HOT_ROWS, hot_keys, lookup
from negsift.schema import KEYS

AS_NEGATIVES, DROP = "as_negatives", "drop"


# --- KD --------------------------------------------------------------------------


def kd_scores(entries: DataFrame) -> DataFrame:
    """One row per query: ids and scores, positives first."""
    listed = F.array_sort(F.collect_list(F.struct("place", "document_id", "score")))
    return (
        entries.groupBy(*QUERY)
        .agg(listed.alias("list"))
        .select(
            *QUERY,
            F.transform("list", lambda e: e["document_id"]).alias("document_ids"),
            F.transform("list", lambda e: e["score"]).alias("scores"),
            F.col("lang").alias("split"),
        )
    )


def entries_of(scores: DataFrame) -> DataFrame:
    """KD rows back in long form."""
    return scores.select(
        *QUERY, F.posexplode(F.arrays_zip("document_ids", "scores")).alias("i", "e")
    ).select(*QUERY, F.col("e.document_ids").alias("document_id"), (F.col("i") + 1).alias("place"), F.col("e.scores").alias("score"))


def kd_queries(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """Queries that have a KD row. Each has exactly one first entry."""
    used = entries.filter("place = 1").select(*QUERY)
    return queries.join(used, QUERY, "left_semi").select(*QUERY, "query", F.col("lang").alias("split"), "pos")


def kd_documents(corpus: DataFrame, entries: DataFrame) -> DataFrame:
    """Documents that occur in a KD row.

    Ids meet ids first; the texts are then read, and chosen by position where they lie.
    """
    on = [*KEYS, "document_id"]
    used = entries.select(*on).distinct()
    wanted = corpus.select(*on, "pos").join(used, on, "left_semi").select(*KEYS, "pos")
    return by_position(corpus, wanted, keep=True).select(*on, "document", F.col("lang").alias("split"), "pos")


# --- contrastive -----------------------------------------------------------------


def _first_is_good(metric: str) -> Column:
    """Whether a first entry makes its query usable.

    For similarities the test is ``score > 0``, which also drops a retrieved
    positive that is not similar at all. For ``l2`` it is the retrieval itself,
    because 0 is the best distance there.
    """
    good = F.col("retrieved") if metric == "l2" else F.col("score") > 0
    return F.when(F.col("place") == 1, good)


def valid_results(entries: DataFrame, metric: str = "cosine") -> DataFrame:
    """Queries with at least two entries whose first one is good."""
    return (
        entries.groupBy(*QUERY)
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.max(F.when(F.col("place") == 1, F.col("score"))).alias("positive_score"),
            F.max(_first_is_good(metric)).alias("good"),
        )
        .filter((F.col("entries") >= 2) & F.col("good"))
        .select(*QUERY, "entries", "positive_score")
    )


def _attach(rows: DataFrame, texts: DataFrame, id_col: str, text: str, hot_rows: int) -> DataFrame:
    on = [*KEYS, id_col]
    dim = texts.select(*on, text)
    hot = dim.join(hot_keys(rows, on, hot_rows), on, "left_semi")
    spread = F.concat_ws(" ", F.lit("row"), "query_id", F.col("ordinal").cast("string"))
    return lookup(rows, dim, on, hot, spread).filter("found").drop("found")


def contrastive_long(
    entries: DataFrame,
    corpus: DataFrame,
    num_negatives: int = 100,
    limit: int | None = None,
    seed: int = 42,
    extra_positives: str = AS_NEGATIVES,
    metric: str = "cosine",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per text of a contrastive row: ordinal -1 is the positive.

    With ``extra_positives="as_negatives"`` everything after the first entry
    counts as a negative, further positives included; ``"drop"`` leaves them out.
    Ids are chosen and numbered first and texts joined last, so bodies are moved
    for the kept entries only. Validity and numbering share one exchange on the
    query. Only an unretrieved positive can be absent from the corpus; such
    entries get no number.
    """
    if extra_positives not in (AS_NEGATIVES, DROP):
        raise ValueError(f"unknown extra_positives: {extra_positives}")
    on = [*KEYS, "document_id"]
    unsure = entries.filter((F.col("place") > 1) & ~F.col("retrieved")).select(*PAIR)
    absent = unsure.join(corpus.select(*on), on, "left_anti").withColumn("absent", F.lit(True))
    of_query = W.partitionBy(*QUERY)
    counted = (F.col("place") > 1) & F.col("absent").isNull()
    if extra_positives == DROP:
        counted = counted & ~F.col("is_pos")
    running = of_query.orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = (
        entries.join(absent, PAIR, "left")
        .withColumn("entries", F.count(F.lit(1)).over(of_query))
        .withColumn("good", F.max(_first_is_good(metric)).over(of_query))
        .filter((F.col("entries") >= 2) & F.col("good"))
        .withColumn("counted", counted)
        .withColumn("ordinal", F.when(F.col("place") == 1, -1).otherwise(F.count_if("counted").over(running) - 1).cast("int"))
        .filter(((F.col("place") == 1) | F.col("counted")) & (F.col("ordinal") < num_negatives))
        .select(*PAIR, "ordinal", "score", "is_pos")
    )
    if limit:
        chosen = sample(valid_results(entries, metric).select(*QUERY), limit, seed, "query_id")
        numbered = numbered.join(chosen, QUERY, "left_semi")
    return _attach(numbered, corpus, "document_id", "document", hot_rows)


def threshold(long: DataFrame, ratio: float, metric: str = "cosine") -> DataFrame:
    """Without the negatives that come too near their positive.

    Similarities: those that score above ``ratio`` times the positive. Distances are small
    where texts are near, so for ``l2`` those below the positive's over ``ratio``.
    """
    best = long.filter("ordinal = -1").select(*QUERY, F.col("score").alias("positive_score"))
    joined = long.join(best, QUERY)
    far = F.col("score") >= F.col("positive_score") / ratio if metric == "l2" else F.col("score") <= ratio * F.col("positive_score")
    return joined.filter((F.col("ordinal") == -1) | far).drop("positive_score")


def contrastive_wide(long: DataFrame, queries: DataFrame, num_negatives: int) -> DataFrame:
    """One row per query with ``num_negatives`` text and score columns.

    Missing negatives are ``""`` and 0.0. The columns are read from one array.
    """
    entry = F.struct("ordinal", "document", "score")
    rows = long.groupBy(*QUERY).agg(
        F.max(F.when(F.col("ordinal") == -1, entry)).alias("pos_entry"),
        F.array_sort(F.collect_list(F.when(F.col("ordinal") >= 0, entry))).alias("neg"),
    )

    def column(i: int, field: str, pad) -> Column:
        return F.coalesce(F.get("neg", F.lit(i))[field], F.lit(pad))

    wide = [
        c
        for i in range(num_negatives)
        for c in (
            column(i, "document", "").alias(f"negative_{i}"),
            column(i, "score", 0.0).alias(f"negative_{i}_score"),
        )
    ]
    return rows.join(queries.select(*QUERY, "query"), QUERY).select(
        *QUERY, "query", F.col("pos_entry.document").alias("positive"), F.col("pos_entry.score").alias("positive_score"), *wide
    )
