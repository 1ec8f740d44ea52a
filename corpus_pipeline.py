"""From raw documents to packed training sequences, stage by stage.

Every stage takes all documents its predecessor kept, as Parquet. All but the last
return the columns of ``documents``. SQL cannot state the groups of near-duplicates, the fitted mix or the
packing, so there is no SQL for the result; the tests hold the stages against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from negsift.llm import mixing, packing, rules, simhash
from negsift.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (3-word shingles, 2 differing bits): the one with the smallest id."""
    return simhash.keep_one(docs, width=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents left out or repeated so that clean and toxic tokens have their target shares.

    Low quality is gone by now, so the domains are those of the other label.
    """
    names = ["toxic"]
    labels = mixing.labelled(spark.read.parquet(f"{sf_dir}/labels.parquet"), names)
    return mixing.resample(docs, labels, mixing.TOXIC_TARGETS, names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the encoded documents, ids included, with their place in a sequence."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("near-dedup", near_dedup), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
