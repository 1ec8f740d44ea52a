"""Small helpers that several operators share."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

#: What splits words: space and \x09 to \x0D, nothing else.
SPACE = r"[\x20\x09-\x0D]"


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of few rows that the driver knows, as a constant in the plan."""
    values = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(values))


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Words of a text: maximal runs without space, tab, \n, \v, \f, \r. Null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart: 128 bits of id and text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("\n"), F.coalesce(text, F.lit(""))))


def numbered(rows: DataFrame, group: str, order: list[str], spread: Column, name: str, per_chunk: int = 50_000) -> DataFrame:
    """``rows`` with a gapless number from 0 within each ``group``, as column ``name``.

    A group is cut into chunks of about ``per_chunk`` rows by ``spread`` (a hash), so
    that no task ranks more than a chunk, also where one group holds most rows. Rows
    are numbered chunk by chunk, within one by ``order``. What is summed up over a
    group is one row per chunk.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / per_chunk).cast("int").alias("_chunks"))
    cut = rows.join(F.broadcast(sizes), group).withColumn("_chunk", F.pmod(spread, F.col("_chunks")).cast("int"))
    counts = cut.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(W.partitionBy(group).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(group, "_chunk", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy(group, "_chunk").orderBy(*order)) - 1
    ranked = cut.withColumn(name, place.cast("long"))
    joined = ranked.join(starts, [group, "_chunk"])
    return joined.withColumn(name, F.col(name) + F.col("_start")).select(*rows.columns, name)
