"""The shapes shared by every plan.

A bundle is one language of one dataset. All bundles travel in the same three
DataFrames and ``KEYS`` is part of each join, grouping and window key, so a
single job serves every language and no query meets another bundle's corpus.

queries  dataset, lang, query_id, query, pos
corpus   dataset, lang, document_id, document, pos
qrels    dataset, lang, query_id, document_id, pos
hits     dataset, lang, query_id, document_id, score, rank

``pos`` is the source position of a row. It is a column and not an assumption
about row order: "first seen" and "source order" always mean "smallest pos".
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

KEYS = ["dataset", "lang"]

#: Score of a positive that retrieval did not return.
NOT_RETRIEVED = -1.0

#: Scores are rounded before they are ranked, so that copies of a vector tie exactly however
#: the matrix product was blocked: to this many places below the size of the pair, which is the
#: product of their lengths to the nearest power of ten. For unit vectors, plain places.
SCORE_PLACES = 9


class Bundle(NamedTuple):
    queries: DataFrame
    corpus: DataFrame
    qrels: DataFrame


def union_bundles(bundles: list[Bundle]) -> Bundle:
    """All languages and datasets of a run as one bundle of tables."""
    merged = bundles[0]
    for other in bundles[1:]:
        merged = Bundle(*(a.unionByName(b) for a, b in zip(merged, other)))
    return merged
