"""Looking up one row per key when a few keys hold much of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot from this many rows on, and if it is among the HOT_KEYS largest. No other
#: key holds more than one in HOT_KEYS of all rows, and the broadcast below is bounded
#: whatever the size of the table.
HOT_ROWS = 1_000_000
HOT_KEYS = 1_000


def hottest(keys: DataFrame, count: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Of one row per key with its ``count``: the largest keys."""
    return keys.filter(F.col(count) >= hot_rows).orderBy(F.desc(count)).limit(HOT_KEYS)


def hot_keys(rows: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The largest keys of ``rows``; the count is combined before the shuffle."""
    return hottest(rows.groupBy(*on).count(), "count", hot_rows).drop("count")


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], hot: DataFrame, spread: Column) -> DataFrame:
    """``facts`` left join ``dim``, where ``dim`` has one row per key.

    Rows of hot keys find theirs in a broadcast of the few ``hot`` dim rows and do
    not take part in the shuffle under that key: the last key column is replaced
    by ``spread``, so they scatter over all tasks. So do rows with a null key.
    Added column ``found``.
    """
    values = [c for c in dim.columns if c not in on]
    last = on[-1]

    def packed(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(*on, F.struct(F.lit(True).alias("found"), *values).alias(name))

    near = facts.join(F.broadcast(packed("_hot", hot)), on, "left")
    cold = F.col("_hot").isNull() & F.col(last).isNotNull()
    probe = near.withColumn("_probe", F.when(cold, F.col(last)).otherwise(spread)).withColumn("_wanted", cold)
    other = packed("_cold", dim).withColumnRenamed(last, "_probe").withColumn("_wanted", F.lit(True))
    joined = probe.join(other, [*on[:-1], "_probe", "_wanted"], "left").drop("_probe", "_wanted")
    value = F.coalesce("_hot", "_cold")
    return joined.select(
        *facts.columns, *[value[c].alias(c) for c in values], F.coalesce(value["found"], F.lit(False)).alias("found")
    )
