"""Exact-size seeded sampling without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from negsift.schema import KEYS

# Fixed value: leading hex digits of the sample key that form a slot, 16^4 slots.
_SLOT_DIGITS = 4


def sample(rows: DataFrame, n: int | None, seed: int, id_col: str, keys: list[str] = KEYS) -> DataFrame:
    """The ``n`` rows per bundle with the smallest MD5 of ``seed:id``; ties by id.

    No limit when ``n`` is 0 or None. The choice depends on ids and seed only, not
    on partitions. Ranking a whole bundle would sort it in one task, so the rows
    are first counted per slot, the leading digits of the key. Slots beyond the one
    that holds the n-th row are dropped before any row moves; the others are ranked
    slot by slot, so that a task ranks a slot's rows and the sample alone is shuffled.
    The slot table has at most 65,536 rows per bundle.
    """
    if not n:
        return rows
    drawn = rows.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))).withColumn(
        "_slot", F.substring("_key", 1, _SLOT_DIGITS)
    )
    sizes = drawn.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    running = W.partitionBy(*keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    slots = (
        sizes.withColumn("_room", F.lit(n) - F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .filter(F.col("_room") > 0)
        .select(*keys, "_slot", "_room")
    )
    place = F.row_number().over(W.partitionBy(*keys, "_slot").orderBy("_key", id_col))
    return (
        drawn.join(F.broadcast(slots), [*keys, "_slot"])
        .withColumn("_place", place)
        .filter(F.col("_place") <= F.col("_room"))
        .select(*rows.columns)
    )


def sample_queries(queries: DataFrame, n: int | None, seed: int = 42) -> DataFrame:
    return sample(queries, n, seed, "query_id")


def qrels_of(qrels: DataFrame, queries: DataFrame) -> DataFrame:
    """Judgements of the given queries only."""
    return qrels.join(queries.select(*KEYS, "query_id"), [*KEYS, "query_id"], "left_semi")
