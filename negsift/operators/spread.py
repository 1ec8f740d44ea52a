"""Using all cores for a small input that is stored in few files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F

#: Only inputs below this size are moved. Larger ones have enough splits, and
#: shuffling them to gain parallelism would cost more than it brings.
SMALL_BYTES = 1 << 30


def spread_small(rows: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """``rows`` over all cores if its files are fewer than these and small.

    For the costly per-row steps: a small table is often one file with one row
    group, and so one task. File lengths come from the file listing.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = rows.inputFiles()
    if not files or len(files) >= cores:
        return rows
    paths = [unquote(file) for file in files]  # they are told as URIs, and read as paths
    lengths = spark.read.format("binaryFile").load(paths).select("length")
    size = lengths.agg(F.sum("length")).first()[0]
    return rows.repartition(cores) if size < small_bytes else rows
