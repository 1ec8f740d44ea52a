"""Source positions for tables that come from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from negsift.session import stored


def counted(rows: DataFrame) -> DataFrame:
    """``rows`` as a file reader gives them, with ``pos``: their position counted over all files by name.

    For formats without a row index. A reader hands out the rows of a file's split in order, and every row lies in the split
    where it starts, so a row's number is that of the rows in earlier splits and before it in
    its own, however the files were split. The rows are parsed and written once, which keeps these
    numbers should a task run again; what is brought together is one row per split.
    """
    if "pos" in rows.columns:
        rows = rows.withColumnRenamed("pos", "source_pos")
    at = [F.col("_metadata.file_path").alias("_pos_file"), F.col("_metadata.file_block_start").alias("_pos_block")]
    written = stored(rows.select("*", *at, F.monotonically_increasing_id().alias("_pos_id")), "positions")
    splits = written.groupBy("_pos_file", "_pos_block").agg(F.min("_pos_id").alias("_pos_first"), F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_pos_file", "_pos_block").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.select("_pos_file", "_pos_block", "_pos_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_pos_start"))
    placed = written.join(F.broadcast(starts), ["_pos_file", "_pos_block"]).withColumn("pos", F.col("_pos_start") + F.col("_pos_id") - F.col("_pos_first"))
    return placed.drop("_pos_file", "_pos_block", "_pos_id", "_pos_first", "_pos_start")


def read_with_pos(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with ``pos``, their position counted over all files by name.

    The row index inside a file comes from the reader. A file starts where the
    files before it end; that running total has one row per file, so it is the
    files that are brought together for it and never the rows.
    """
    rows = spark.read.parquet(path)
    if "pos" in rows.columns:
        rows = rows.withColumnRenamed("pos", "source_pos")
    rows = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    sizes = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        rows.join(F.broadcast(starts), "_file")
        .withColumn("pos", F.col("_start") + F.col("_row"))
        .drop("_file", "_row", "_start")
    )
