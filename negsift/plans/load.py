"""From stored datasets to one bundle of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from negsift.plans.params import COIR, Dataset
from negsift.schema import Bundle, union_bundles
from negsift.sources.beir import beir_bundle
from negsift.sources.layout import fan_out, qrels_split_or_default, read_table, subset_name, table_path
from negsift.sources.paired import paired_bundle


def _rows(spark: SparkSession, root: str, spec: Dataset, config: str | None, split: str) -> DataFrame:
    """One part of a dataset for all of its languages, with dataset and lang.

    A dataset without per-language parts is read once and every language gets its
    rows. ``config`` None is the paired layout, whose part name is the language.
    """

    def read(subset: str | None) -> DataFrame:
        return read_table(spark, table_path(root, spec.name, subset, split), spec.format, spec.schema, spec.pos_field)

    if not spec.lang_as_config:
        rows = fan_out(read(config), spec.languages)
    else:
        parts = [
            read(lang if config is None else subset_name(config, lang, True, spec.lang_config_format)).withColumn(
                "lang", F.lit(lang)
            )
            for lang in spec.languages
        ]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.withColumn("dataset", F.lit(spec.name))


def load_dataset(spark: SparkSession, root: str, spec: Dataset) -> Bundle:
    if spec.layout != COIR:
        return paired_bundle(
            _rows(spark, root, spec, None, spec.split),
            spec.query_field,
            spec.documents_field,
            spec.strip_docstrings,
            spec.deduplicate_corpus,
        )
    return beir_bundle(
        _rows(spark, root, spec, spec.corpus_config, spec.corpus_split),
        _rows(spark, root, spec, spec.queries_config, spec.queries_split),
        _rows(spark, root, spec, spec.qrels_config, qrels_split_or_default(spec.qrels_split, spec.split)),
        spec.corpus_text_field,
        spec.corpus_id_field,
        spec.queries_text_field,
        spec.queries_id_field,
        spec.qrels_query_id_field,
        spec.qrels_corpus_id_field,
        spec.qrels_score_field,
        spec.strip_docstrings,
        spec.deduplicate_corpus,
    )


def load_datasets(spark: SparkSession, root: str, specs: list[Dataset]) -> Bundle:
    return union_bundles([load_dataset(spark, root, spec) for spec in specs])
