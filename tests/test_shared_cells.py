"""Searches by cells that bring most pairs together: each query and document comes once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.operators import index, late
from negsift.operators.scorers import CentroidMaxSim
from negsift.operators.topk import emitted
from negsift.schema import KEYS
from negsift.session import scratch_path
from rows import K

QUERIES, DOCUMENTS, CELLS = 37, 300, 70  # more cells than one word has bits
CENTROIDS = np.random.default_rng(1).normal(size=(CELLS, 4))


def tokens(spark, many, name, seed, least=3, parts=1):
    rng = np.random.default_rng(seed)
    rows = [("s", lang, f"{lang}{i:03}", rng.normal(size=(rng.integers(least, 4), 4)).tolist()) for lang in ("x", "y") for i in range(many)]
    return spark.createDataFrame(rows, K + f"{name} string, tokens array<array<double>>").repartition(parts)


def both(spark, least=3, parts=1):
    return tokens(spark, QUERIES, "query_id", 2, least), tokens(spark, DOCUMENTS, "document_id", 3, least, parts)


def hits(found):
    return sorted((r["lang"], r["query_id"], r["rank"], r["document_id"], r["score"]) for r in found.collect())


def known(nlist):
    return {("s", lang): CENTROIDS[:nlist] for lang in ("x", "y")}


@pytest.mark.parametrize("least,nlist,nprobe,full", [(0, 70, 40, 20), (3, 8, 2, 20), (0, 8, 2, None)])
def test_pairs_under_their_bundle_give_the_hits_of_pairs_under_cells(spark, monkeypatch, least, nlist, nprobe, full):
    queries, documents = both(spark, least)
    search = lambda: hits(late.plaid_topk(queries, documents, 5, nprobe=nprobe, full_scores=full, centroids=known(nlist)))
    monkeypatch.setattr(late, "MET_SHARE", 0.0)
    once = search()
    monkeypatch.setattr(late, "MET_SHARE", 1e9)
    assert once and once == search()


def asked_of(monkeypatch):
    """Rows of queries that searches are given."""
    given, topk = [], late.topk

    def counted(queries, *rest, **options):
        given.append(queries.count())
        return topk(queries, *rest, **options)

    monkeypatch.setattr(late, "topk", counted)
    return given


@pytest.mark.parametrize("full", [None, 20])
def test_queries_that_probe_most_cells_come_once(spark, monkeypatch, full):
    given = asked_of(monkeypatch)
    queries, documents = both(spark)
    late.plaid_topk(queries, documents, 5, nprobe=8, full_scores=full, centroids=known(8)).collect()
    assert given == [2 * QUERIES]


def test_a_saved_index_searched_in_most_cells_gets_each_query_once(spark, monkeypatch):
    given = asked_of(monkeypatch)
    monkeypatch.setattr(index, "topk", late.topk)
    queries, documents = both(spark)
    path = scratch_path(spark, "index")
    index.build_index(documents.filter("substring(document_id, 2) < '200'"), path, "plaid", nlist=8)
    index.append_index(documents, path)
    once = hits(index.search_index(queries, path, 5, nprobe=2))
    assert given == [2 * QUERIES]
    monkeypatch.setattr(late, "MET_SHARE", 1e9)
    assert len(once) == 2 * QUERIES * 5 and once == hits(index.search_index(queries, path, 5, nprobe=2))


def test_a_light_search_sends_on_k_rows_a_query(spark):
    queries, documents = both(spark, parts=8)
    codes = documents.select(*KEYS, "document_id", late.token_codes(documents, known(8)).alias("codes"))
    scorer = CentroidMaxSim(spark.sparkContext.broadcast(known(8)))
    sent = emitted(queries, codes, 20, scorer)
    assert sent.groupBy(*KEYS, "query_id").count().agg(F.max("count")).first()[0] == 20
    assert sent.count() == 2 * QUERIES * 20


def test_given_pairs_score_alike_for_texts_of_equal_and_unequal_length(spark):
    for least in (0, 3):
        queries, documents = both(spark, least)
        pairs = queries.join(documents.drop("tokens"), KEYS).select(*KEYS, "query_id", "document_id")
        q = {(r["lang"], r["query_id"]): np.array(r["tokens"]).reshape(-1, 4) for r in queries.collect()}
        d = {(r["lang"], r["document_id"]): np.array(r["tokens"]).reshape(-1, 4) for r in documents.collect()}
        for limit in (0, 1 << 20):
            found = late.exact_scores(pairs, queries, documents, limit).collect()
            assert len(found) == 2 * QUERIES * DOCUMENTS
            for r in found:
                a, b = q[r["lang"], r["query_id"]], d[r["lang"], r["document_id"]]
                want = (a @ b.T).max(axis=1).sum() if len(a) and len(b) else 0.0
                assert abs(r["score"] - want) < 1e-6
