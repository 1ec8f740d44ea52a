"""Gapless numbers in a global order, and places within groups that may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from negsift.session import stored

_WITHIN = 33  # bits of a row's place in its partition, as Spark's row ids have it


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place in ``order`` from 0, as column ``name``.

    The rows are sorted by ranges and written; a row's number is its place in its range plus the sizes of
    the ranges before. What is brought together is one row per range, and no value of ``order`` keeps its
    rows in one task as long as ``order`` ends with something that tells them apart.
    """
    placed = stored(rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id()), "in-order")
    part, within = F.shiftright(name, _WITHIN), F.col(name).bitwiseAND(F.lit((1 << _WITHIN) - 1))
    sizes = placed.groupBy(part.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("_range", before.alias("_before")))
    joined = placed.withColumn("_range", part).join(starts, "_range")
    return joined.withColumn(name, within + F.col("_before")).drop("_range", "_before")
