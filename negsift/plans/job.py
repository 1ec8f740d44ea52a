"""The whole job: load, mine, write. Every dataset and language in one plan."""

from __future__ import annotations

import os
import uuid
from dataclasses import replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from negsift.operators import formats, mine
from negsift.operators.sample import sample_queries
from negsift.plans import ledger
from negsift.plans.load import load_datasets
from negsift.plans.params import BOTH, COIR, CONTRASTIVE, KD, Dataset, Mining, Output
from negsift.schema import Bundle, KEYS
from negsift.session import stored
from negsift.sources.layout import config_name


class Mined(NamedTuple):
    queries: DataFrame
    corpus: DataFrame
    entries: DataFrame


def mine_bundle(bundle: Bundle, mining: Mining, max_queries: int | None = None, seed: int = 42) -> Mined:
    """Sample the queries, search the whole corpus for them, split the hits.

    Sampling comes before encoding, the costly step. The sampled queries and the entries
    are written once, because search, both outputs and the report read them.
    """
    queries = stored(sample_queries(bundle.queries, max_queries, seed), "queries")
    hits = mining.retriever(
        queries, bundle.corpus, mining.top_k, architecture=mining.architecture, encode=mining.encode, **mining.search
    )
    entries = mine.mined_entries(queries, hits, bundle.qrels, mining.num_negatives, mining.metric, mining.l2_parity)
    return Mined(queries, bundle.corpus, stored(entries, "entries"))


def kd_dataset(mined: Mined) -> dict[str, DataFrame]:
    return {
        "queries": formats.kd_queries(mined.queries, mined.entries),
        "documents": formats.kd_documents(mined.corpus, mined.entries),
        "scores": formats.kd_scores(mined.entries),
    }


def contrastive_dataset(mined: Mined, corpus: DataFrame, mining: Mining, output: Output) -> DataFrame:
    long = formats.contrastive_long(
        mined.entries,
        corpus,
        output.max_per_query,
        output.max_per_language,
        output.seed,
        output.extra_positives,
        mining.metric,
    )
    if output.threshold is not None:
        long = formats.threshold(long, output.threshold, mining.metric)
    return formats.contrastive_wide(long, mined.queries, output.max_per_query)


def _in_source_order(rows: DataFrame) -> DataFrame:
    """Files in order, and rows in order within them: a reader that counts positions over
    the files by name counts the source's."""
    return rows.repartitionByRange(*KEYS, "pos").sortWithinPartitions(*KEYS, "pos") if "pos" in rows.columns else rows


def _config(specs: list[Dataset]) -> Column:
    """Published name of a bundle. Names of datasets are literals of the job."""
    coir = F.col("dataset").isin([spec.name for spec in specs if spec.layout == COIR])
    dataset, lang = F.col("dataset"), F.col("lang")
    return F.when(coir, config_name(COIR, dataset, lang)).otherwise(config_name("", dataset, lang))


def replace_parts(rows: DataFrame, path: str, folders: list[str] = KEYS) -> None:
    """Write ``rows`` by config and bundle; only the parts they hold are replaced."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("config", *folders).parquet(path)


#: What a published file holds besides its folders' dataset and language.
PUBLISHED = {
    "queries": ["query_id", "query", "split"],
    "documents": ["document_id", "document", "split"],
    "scores": ["query_id", "document_ids", "scores", "split"],
}


def _local(subset: str) -> str:
    return os.path.join(KD, subset) if subset != CONTRASTIVE else CONTRASTIVE


def _publish(spark: SparkSession, subset: str, schema, specs: list[Dataset], output: Output) -> None:
    """The published layout: ``<name>_kd/config=<subset>_<config>`` and ``<name>/config=<config>``.

    Published files hold the published columns only.
    """
    kd = subset != CONTRASTIVE
    config = F.concat(F.lit(f"{subset}_"), _config(specs)) if kd else _config(specs)
    written = _of(spark.read.schema(schema).parquet(os.path.join(output.path, _local(subset))), specs)
    target = os.path.join(output.path, output.name + ("_kd" if kd else ""))
    columns = PUBLISHED.get(subset) or [c for c in schema.names if c not in (*KEYS, "query_id")]
    published = _in_source_order(written.withColumn("config", config))
    replace_parts(published.select("config", *KEYS, *columns), target)


def _of(rows: DataFrame, specs: list[Dataset]) -> DataFrame:
    """Rows of the bundles of some datasets; others' folders are not read."""
    wanted = F.lit(False)
    for spec in specs:
        wanted = wanted | ((F.col("dataset") == spec.name) & F.col("lang").isin(spec.languages))
    return rows.filter(wanted)


def run_job(
    spark: SparkSession, root: str, datasets: list[Dataset], mining: Mining, output: Output
) -> DataFrame:
    """Run it all; returns the mining counters with a ``status`` per bundle.

    All datasets go through one plan, or ``output.datasets_per_step`` of them at a time. Each step
    replaces its own bundles in the output and no others. With ``output.resume``, bundles that an
    earlier run with the same parameters has finished are left as they are, and reported as then.
    """
    if output.kind not in (KD, CONTRASTIVE, BOTH):
        raise ValueError(f"unknown output: {output.kind}")
    digests = {
        (spec.name, lang): ledger.digest(replace(spec, languages=[lang]), mining, replace(output, resume=False, datasets_per_step=None))
        for spec in datasets
        for lang in spec.languages
    }
    done: dict[tuple[str, str], Row] = {}
    if output.resume:
        rows = ledger.finished(spark, output.path).collect()  # a row per bundle
        done = {(r["dataset"], r["lang"]): r for r in rows if digests.get((r["dataset"], r["lang"])) == r["digest"]}
        left = [replace(spec, languages=[lang for lang in spec.languages if (spec.name, lang) not in done]) for spec in datasets]
        datasets = [spec for spec in left if spec.languages]
    each = output.datasets_per_step or len(datasets) or 1
    reports = [_step(spark, root, datasets[at : at + each], mining, output, digests) for at in range(0, len(datasets), each)]
    if done or not reports:
        known = [(*key, *[r[c] for c in ledger.COLUMNS]) for key, r in done.items() if r["status"] is not None]
        reports.append(spark.createDataFrame(known, f"dataset string, lang string, {ledger.COUNTERS}"))
    return reduce(DataFrame.unionByName, [r.select(*KEYS, *ledger.COLUMNS) for r in reports])


def _step(spark: SparkSession, root: str, datasets: list[Dataset], mining: Mining, output: Output, digests: dict) -> DataFrame:
    """Mine some datasets, stage their output, put it in place and enter it in the ledger.

    Document texts are taken from the corpus once, for the KD documents. The
    contrastive rows take theirs from that smaller table when it is written.
    """
    bundle = load_datasets(spark, root, datasets)
    mined = mine_bundle(bundle, mining, output.max_per_language, output.seed)
    corpus = mined.corpus
    staging, schemas = os.path.join(output.path, "_staging", uuid.uuid4().hex), {}

    def stage(rows: DataFrame, subset: str) -> str:
        schemas[subset] = rows.schema
        folder = os.path.join(staging, _local(subset))
        _in_source_order(rows).write.partitionBy(*KEYS).parquet(folder)
        return folder

    if output.kind in (KD, BOTH):
        tables = kd_dataset(mined)
        folders = {subset: stage(rows, subset) for subset, rows in tables.items()}
        corpus = spark.read.schema(tables["documents"].schema).parquet(folders["documents"])
    if output.kind in (CONTRASTIVE, BOTH):
        stage(contrastive_dataset(mined, corpus, mining, output), CONTRASTIVE)
    valid = formats.valid_results(mined.entries, mining.metric).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("valid"))
    status = F.when(F.col("results") == 0, "no results").when(F.col("valid") == 0, "no valid queries").otherwise("written")
    report = mine.mining_report(mined.queries, mined.entries, bundle.queries).join(valid, KEYS, "left").fillna(0, ["valid"])
    report = stored(report.withColumn("status", status).select(*KEYS, *ledger.COLUMNS), "report")

    files = ledger.Files(spark, output.path)
    own = {(spec.name, lang): digests[spec.name, lang] for spec in datasets for lang in spec.languages}
    for subset in schemas:
        files.replace(os.path.join(staging, _local(subset)), os.path.join(output.path, _local(subset)), list(own))
    for subset, schema in schemas.items() if output.name else ():
        _publish(spark, subset, schema, datasets, output)
    ledger.enter(report, own, output.path)
    files.delete(staging)
    return report
