"""Parameters of a job. Defaults are fixed values of the job's contract."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from negsift.operators.formats import AS_NEGATIVES
from negsift.operators.retrieve import retrieve
from negsift.sources.layout import CORPUS, CORPUS_SPLIT, QRELS, QUERIES, QUERIES_SPLIT, SPLIT, SUBSET_TEMPLATE

PAIRED, COIR = "paired", "coir"
KD, CONTRASTIVE, BOTH = "kd", "contrastive", "both"


@dataclass(frozen=True)
class Dataset:
    """Where the tables of a dataset are and what their columns are called.

    ``layout="coir"`` reads corpus, queries and qrels; any other value reads
    paired rows. ``pos_field`` names a column that holds the source position; without
    it positions are counted, which only Parquet allows.
    """

    name: str
    languages: list[str]
    layout: str = PAIRED
    format: str = "parquet"
    schema: Any = None
    pos_field: str = ""
    lang_as_config: bool = False
    split: str = SPLIT
    query_field: str = ""
    documents_field: str = ""
    corpus_config: str = CORPUS
    queries_config: str = QUERIES
    qrels_config: str = QRELS
    corpus_split: str = CORPUS_SPLIT
    queries_split: str = QUERIES_SPLIT
    qrels_split: str = ""
    lang_config_format: str = SUBSET_TEMPLATE
    corpus_text_field: str = "text"
    corpus_id_field: str = "_id"
    queries_text_field: str = "text"
    queries_id_field: str = "_id"
    qrels_query_id_field: str = "query-id"
    qrels_corpus_id_field: str = "corpus-id"
    qrels_score_field: str = "score"
    strip_docstrings: bool = False
    deduplicate_corpus: bool = False


@dataclass(frozen=True)
class Mining:
    """How negatives are found. ``search`` goes to the retriever: metric, method,
    nlist and so on. ``retriever`` may be any function with its signature."""

    top_k: int = 200
    num_negatives: int = 100
    architecture: str = "single_vector"
    encode: Callable | None = None
    search: dict[str, Any] = field(default_factory=dict)
    l2_parity: bool = False
    retriever: Callable = retrieve

    @property
    def metric(self) -> str:
        return self.search.get("metric", "cosine")


@dataclass(frozen=True)
class Output:
    """What is written and where. ``name`` adds the published layout under ``path``.

    Limits are off unless they are set; the report counts what a limit leaves out.
    ``datasets_per_step`` datasets are mined and put in place at a time, by default all; with
    ``resume`` finished ones are not mined again. ``threshold`` leaves out negatives that come too near their positive, see
    :func:`negsift.operators.formats.threshold`.
    """

    path: str
    kind: str = BOTH
    name: str = ""
    max_per_language: int | None = None
    max_per_query: int = 100
    seed: int = 42
    extra_positives: str = AS_NEGATIVES
    threshold: float | None = None
    datasets_per_step: int | None = None
    resume: bool = False
