"""Where the tables of a dataset live, and how its parts are named."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from negsift.functions.text import short_name
from negsift.sources.positions import counted, read_with_pos

# Default part names, splits and columns of the three-table layout.
CORPUS, QUERIES, QRELS = "corpus", "queries", "default"
SPLIT, CORPUS_SPLIT, QUERIES_SPLIT = "train", "corpus", "queries"
SUBSET_TEMPLATE = "{config}_{lang}"


def subset_name(config: str, lang: str, lang_as_config: bool, template: str = SUBSET_TEMPLATE) -> str:
    """Part name of a language: by template, or the plain name without languages."""
    return template.format(config=config, lang=lang) if lang_as_config else config


def qrels_split_or_default(qrels_split: str, split: str) -> str:
    return qrels_split or split


def table_path(root: str, dataset: str, subset: str | None, split: str) -> str:
    return os.path.join(root, dataset, *([subset] if subset else []), split)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, pos_field: str = "") -> DataFrame:
    """A table with ``pos``, its source position as a long.

    ``pos_field`` names the column that holds it. Without one it is counted over the
    files by name. A column that merely is called ``pos``
    is no position and comes out as ``source_pos``.
    """
    if fmt == "parquet" and not pos_field:
        return read_with_pos(spark, path)
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    rows = reader.format(fmt).load(path)
    if not pos_field:
        return counted(rows)
    if pos_field not in rows.columns:
        raise ValueError(f"no column {pos_field}, named by pos_field: {path}")
    position = F.col(f"`{pos_field}`").cast("long")
    if pos_field != "pos" and "pos" in rows.columns:
        rows = rows.withColumnRenamed("pos", "source_pos")
    return rows.withColumn("pos", position)


def fan_out(rows: DataFrame, languages: list[str]) -> DataFrame:
    """One copy of a table per language, for datasets without per-language parts."""
    return rows.withColumn("lang", F.explode(F.array(*[F.lit(name) for name in languages])))


def config_name(layout: str, dataset: Column, lang: Column) -> Column:
    """``<task>-<lang>`` for the three-table layout and ``<lang>`` for paired rows."""
    return F.concat(short_name(dataset), F.lit("-"), lang) if layout == "coir" else lang
