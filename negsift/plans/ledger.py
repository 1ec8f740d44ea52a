"""What a job has finished: staged output, its commit bundle by bundle, and a ledger of it.

Output is written to a staging folder first. When all parts of a run are there, the folders of its bundles take the
place of older ones; other datasets' folders are not touched. Last comes a ledger row per
bundle, so a bundle without one counts as not done. A job that is started again with the same
parameters can leave out the bundles that the ledger has.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import os
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from negsift.schema import KEYS

LEDGER = "ledger"
#: The counters of a finished bundle, as the job reports them.
COUNTERS = "queries_available long, queries long, results long, positives_not_retrieved long, skipped long, valid long, status string"
_SCHEMA = f"dataset string, lang string, digest string, at timestamp, {COUNTERS}"
COLUMNS = [c.split()[0] for c in COUNTERS.split(", ")]


def digest(*params: Any) -> str:
    """What tells the parameters of runs apart; functions count by their names."""

    def plain(value: Any):
        if dataclasses.is_dataclass(value):
            return {f.name: plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
        if isinstance(value, dict):
            return {str(k): plain(v) for k, v in value.items()}
        if isinstance(value, (list, tuple)):
            return [plain(v) for v in value]
        if callable(value):
            return f"{getattr(value, '__module__', '')}.{getattr(value, '__qualname__', type(value).__name__)}"
        return value if isinstance(value, (str, int, float, bool, type(None))) else str(value)

    return hashlib.md5(json.dumps([plain(p) for p in params], sort_keys=True).encode()).hexdigest()


class Files:
    """Folders of the output's file system; only names are listed, a few per bundle."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def bundles(self, folder: str) -> dict[tuple[str, str], str]:
        """Folder of each bundle under ``folder``."""
        out = {}
        for dataset in self.names(folder):
            for lang in self.names(f"{folder}/{dataset}") if dataset.startswith("dataset=") else []:
                if lang.startswith("lang="):
                    out[unquote(dataset[len("dataset=") :]), unquote(lang[len("lang=") :])] = f"{dataset}/{lang}"
        return out

    def replace(self, new: str, old: str, bundles: list[tuple[str, str]]) -> None:
        """The folders of ``bundles`` under ``new`` take the place of those under ``old``, which go also without a new one."""
        had, have = self.bundles(old), self.bundles(new)
        self.fs.mkdirs(self.path(old))
        for bundle in bundles:
            if bundle in had:
                self.fs.delete(self.path(f"{old}/{had[bundle]}"), True)
            if bundle in have:
                target = self.path(f"{old}/{have[bundle]}")
                self.fs.mkdirs(target.getParent())
                if not self.fs.rename(self.path(f"{new}/{have[bundle]}"), target):
                    raise OSError(f"{new}/{have[bundle]} could not be moved to {target}")

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


def finished(spark: SparkSession, root: str) -> DataFrame:
    """The last ledger row of each bundle."""
    folder = os.path.join(root, LEDGER)
    if not Files(spark, root).names(folder):
        return spark.createDataFrame([], _SCHEMA)
    rows = spark.read.schema(_SCHEMA).parquet(folder)
    whole = F.struct("at", "digest", *COLUMNS)
    return rows.groupBy(*KEYS).agg(F.max_by(whole, "at").alias("r")).select(*KEYS, "r.*")


def enter(report: DataFrame, digests: dict[tuple[str, str], str], root: str) -> None:
    """Write the ledger rows of finished bundles."""
    spark = report.sparkSession
    known = spark.createDataFrame([(*key, value) for key, value in digests.items()], "dataset string, lang string, digest string")
    rows = known.join(report, KEYS, "left").withColumn("at", F.current_timestamp())
    rows.select(*[c.split()[0] for c in _SCHEMA.split(", ")]).coalesce(1).write.mode("append").parquet(os.path.join(root, LEDGER))
