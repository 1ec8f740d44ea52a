"""Connected components of an edge table, by joins and minima alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from negsift.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``) that is not its component's smallest.

    Alternates two steps until nothing changes: every node's larger neighbours are
    linked to its smallest one (itself included), then its smaller neighbours are. Each
    turn's edges are written to the shared folder; only their count and checksum come to
    the driver. A node with very many neighbours is reduced to one minimum before the
    shuffle, and what it joins with has one row per node. Self links and repeated links
    change nothing; an edge with a null end is left out.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while (after := _mark(now)) != mark:
        mark = after
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("_of")).agg(F.least(F.first("a"), F.min("b")).alias("least"))
        down = both.filter("b > a").join(least, F.col("a") == F.col("_of"))
        large = down.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # The smallest edges of a component's root itself are among these: b > root links to root.
        least = large.groupBy(F.col("a").alias("_of")).agg(F.min("b").alias("least"))
        over = large.join(least, F.col("a") == F.col("_of"))
        small = over.select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
        now = stored(small.select("e.a", "e.b").filter("a <> b").distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """What tells one edge set from another: its size and an order-free checksum."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
