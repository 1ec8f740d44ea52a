"""Dedup of KD datasets that are already published."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from negsift.operators.dedup import dedup_corpus, dedup_report, id_map, remap_scores, text_keys
from negsift.plans.job import PUBLISHED, replace_parts
from negsift.schema import KEYS
from negsift.session import stored
from negsift.sources.positions import read_with_pos

# Published subsets known to hold many copies.
DEFAULT_TARGETS = (
    "cosqa-python",
    "codetrans-dl-mixed",
    "codefeedback-st-mixed",
    "synthetic-text2sql-sql",
    "codesearchnet-ccr-go",
    "codesearchnet-ccr-java",
    "codesearchnet-ccr-javascript",
    "codesearchnet-ccr-php",
    "codesearchnet-ccr-python",
    "codesearchnet-ccr-ruby",
)

TARGET = ["target", *KEYS]


def read_subset(spark: SparkSession, root: str, subset: str, target: str) -> DataFrame:
    """A published subset: its plain columns, and the position counted over its files.

    Dataset and language are taken from the folders if there are any.
    """
    rows = read_with_pos(spark, os.path.join(root, f"config={subset}_{target}")).withColumn("target", F.lit(target))
    own = {c: F.col(c).cast("string") if c in rows.columns else F.lit("") for c in KEYS}
    return rows.withColumns(own)


def dedup_published(
    spark: SparkSession, root: str, out: str, targets: tuple[str, ...] = DEFAULT_TARGETS, dry_run: bool = False
) -> DataFrame:
    """Merge copies in ``documents_<target>`` and remap ``scores_<target>``.

    Writes ``config=<subset>_<target>`` folders to ``out``, and only of targets that
    change. Returns the dedup report with a ``status`` and an ``error`` per target. All
    targets that can be read go through one plan; should it fail, each runs alone and
    writes to the same folders, so that one bad target does not hold up the rest. A
    folder is replaced when all of it is written.
    """
    readable, failed = [], []
    for target in targets:
        try:
            for subset in ("documents", "scores"):
                read_subset(spark, root, subset, target)
            readable.append(target)
        except Exception as error:
            failed.append((target, str(error)))
    reports = []
    if readable:
        try:
            reports += [_process(spark, root, out, some, dry_run) for some in _alike(spark, root, readable)]
        except Exception:
            reports = []
            for target in readable:
                try:
                    reports.append(_process(spark, root, out, [target], dry_run))
                except Exception as error:
                    failed.append((target, str(error)))
    errors = spark.createDataFrame(failed, "target string, error string").withColumn("status", F.lit("failed"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*reports, errors])


def _folders(spark: SparkSession, root: str, target: str) -> list[str]:
    columns = spark.read.parquet(os.path.join(root, f"config=documents_{target}")).columns
    return [c for c in KEYS if c in columns]


def _alike(spark: SparkSession, root: str, targets: list[str]) -> list[list[str]]:
    """Targets that have the same folders below their own, together."""
    groups: dict[tuple, list[str]] = {}
    for target in targets:
        groups.setdefault(tuple(_folders(spark, root, target)), []).append(target)
    return list(groups.values())


def _process(spark: SparkSession, root: str, out: str, targets: list[str], dry_run: bool) -> DataFrame:
    def every(subset: str) -> DataFrame:
        rows = [read_subset(spark, root, subset, t).select(*TARGET, "pos", *PUBLISHED[subset]) for t in targets]
        return reduce(lambda a, b: a.unionByName(b), rows)

    documents, scores = every("documents"), every("scores")
    digests = stored(text_keys(documents, TARGET), "text-keys")
    report = stored(dedup_report(digests, TARGET), "dedup-report")
    # At most one row per target and bundle.
    changed = F.broadcast(report.filter("removed > 0").select(*TARGET))
    if not dry_run and report.filter("removed > 0").limit(1).count():
        documents = documents.join(changed, TARGET, "left_semi")
        scores = scores.join(changed, TARGET, "left_semi")
        digests = digests.join(changed, TARGET, "left_semi")
        mapping = id_map(digests, TARGET)
        for subset, rows in (
            ("documents", dedup_corpus(documents, TARGET, digests=digests)),
            ("scores", remap_scores(scores, mapping, TARGET)),
        ):
            rows = rows.withColumn("config", F.concat(F.lit(f"{subset}_"), "target"))
            if "pos" in rows.columns:
                rows = rows.repartitionByRange("target", "pos").sortWithinPartitions("target", "pos")
            folders = _folders(spark, root, targets[0])
            replace_parts(rows.select("config", *folders, *PUBLISHED[subset]), out, folders)
    done = F.lit("would change" if dry_run else "changed")
    return report.withColumn("status", F.when(F.col("removed") > 0, done).otherwise("no duplicates"))
