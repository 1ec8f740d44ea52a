"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "negsift", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without it; there a fresh temporary folder does.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="negsift-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results with several readers: it cuts the lineage, so losing an executor
    costs a re-read and not a second retrieval. ``by`` makes a folder per value,
    for readers that want one value only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*(by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
