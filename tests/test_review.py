"""Cases that went wrong once: repeated ids, empty bundles, small scores, distances, second runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.operators import cells, encode, formats, late, mine
from negsift.operators.dedup import remap_scores
from negsift.operators.retrieve import knn, retrieve
from negsift.operators.scorers import Dense, MaxSim
from negsift.operators.topk import emitted
from negsift.plans.job import run_job
from negsift.plans.load import load_dataset
from negsift.plans.params import Dataset, Mining, Output
from negsift.plans.posthoc import dedup_published
from negsift.sources.layout import read_table
from rows import K, as_set, corpus, hits, qrels, queries, vectors

RNG = np.random.default_rng(11)


def ranks(found):
    return as_set(found, "query_id", "document_id", "rank")


@pytest.mark.parametrize("metric", ["ip", "l2", "cosine"])
@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_order_does_not_depend_on_scale(spark, metric, scale):
    q, d = RNG.normal(size=(5, 8)), RNG.normal(size=(60, 8))
    rows = lambda x, c, s: vectors(spark, [(f"{c[0]}{i:03}", v * s) for i, v in enumerate(x)], c)
    want = ranks(knn(rows(q, "query_id", 1.0), rows(d, "document_id", 1.0), 10, metric))
    for form in ("broadcast", "blocks"):
        assert ranks(knn(rows(q, "query_id", scale), rows(d, "document_id", scale), 10, metric, form=form)) == want


def test_small_scores_are_not_zero(spark):
    queries = vectors(spark, [("q", [1e-6, 0])], "query_id")
    found = knn(queries, vectors(spark, [("a", [1e-6, 0]), ("c", [9e-6, 0])], "document_id"), 2, "ip")
    assert [(r["document_id"], r["score"]) for r in found.orderBy("rank").collect()] == [("c", pytest.approx(9e-12)), ("a", pytest.approx(1e-12))]


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
@pytest.mark.parametrize("form", ["broadcast", "blocks"])
def test_floors_change_nothing_but_the_volume(spark, metric, form):
    q = vectors(spark, [(f"q{i}", v) for i, v in enumerate(RNG.normal(size=(12, 8)))], "query_id")
    d = vectors(spark, [(f"d{i}", v) for i, v in enumerate(RNG.normal(size=(3000, 8)))], "document_id").repartition(40)
    options = {"form": form, "doc_block": 50, "floor_rows": 1, "floor_share": 4}
    assert ranks(knn(q, d, 5, metric, **options)) == ranks(knn(q, d, 5, metric))
    volume = lambda **o: emitted(q, d, 5, Dense(metric), ascending=metric == "l2", **o).count()
    assert volume(**options) <= 2 * 4 * 5 * 12
    if form == "blocks":
        assert volume(form=form, doc_block=50) >= 10 * volume(**options)


def test_a_bundle_with_queries_only(spark):
    q = vectors(spark, [("q", [1, 0])], "query_id", "x").unionByName(vectors(spark, [("p", [1, 0])], "query_id", "y"))
    d = vectors(spark, [(f"d{i}", v) for i, v in enumerate(RNG.normal(size=(60, 2)))], "document_id", "x")
    for options in ({}, {"method": "ivf", "nlist": 2}, {"method": "ivfpq", "nlist": 2, "m_pq": 2}, {"method": "hnsw"}, {"method": "lsh", "hash_bits": 1}, {"method": "ivf_exact", "nlist": 2}):
        assert as_set(knn(q, d, 3, **options), "lang", "query_id") == {("x", "q")}
    tokens = lambda rows: encode.token_matrix(rows, 2, 1)
    assert as_set(late.plaid_topk(tokens(q), tokens(d), 3, nlist=4), "lang") == {("x",)}


def test_threshold_by_metric(spark):
    found = [("q", "a", 0.2), ("q", "b", 0.1), ("q", "c", 0.3), ("q", "d", 5.0)]
    entries = mine.mined_entries(queries(spark, ["q"]), hits(spark, found), qrels(spark, [("q", "a")]), 9, "l2")
    long = formats.contrastive_long(entries, corpus(spark, {d: d for d in "abcd"}), 9, metric="l2")
    assert as_set(formats.threshold(long, 0.95, "l2"), "document_id") == {("a",), ("c",), ("d",)}


def test_rows_of_one_query_stay_apart(spark):
    rows = [("s", "x", "q", ["a", "b"], [0.9, 0.8], "x"), ("s", "x", "q", ["b"], [0.7], "x")]
    scores = spark.createDataFrame(rows, K + "query_id string, document_ids array<string>, scores array<double>, split string")
    mapping = spark.createDataFrame([("s", "x", "b", "a")], K + "document_id string, canonical_id string")
    got = sorted((r["document_ids"], r["scores"]) for r in remap_scores(scores, mapping).collect())
    assert got == [(["a"], [0.7]), (["a"], [0.9])]


def beir(spark, root, corpus_rows, query_rows, judged):
    for part, rows, schema in (("corpus/corpus", corpus_rows, "_id string, text string"), ("queries/queries", query_rows, "_id string, text string"),
                               ("default/train", judged, "`query-id` string, `corpus-id` string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/Org/Set/{part}")
    return Dataset("Org/Set", ["go"], layout="coir")


def test_repeated_ids_count_once(spark, tmp_path):
    spec = beir(
        spark, str(tmp_path), [("a", "alpha one"), ("b", "old beta"), ("c", "gamma one"), ("b", "beta one")],
        [("q", "old question"), ("q", "alpha one")], [("q", "a")],
    )
    bundle = load_dataset(spark, str(tmp_path), spec)
    assert as_set(bundle.corpus, "document_id", "document") == {("a", "alpha one"), ("b", "beta one"), ("c", "gamma one")}
    assert as_set(bundle.queries, "query_id", "query") == {("q", "alpha one")}
    out = str(tmp_path / "out")
    mining = Mining(10, 5, encode=encode.hashed_encoder(64))
    for _ in range(2):  # a second run replaces the first
        run_job(spark, str(tmp_path), [spec], mining, Output(out, name="set", max_per_query=3))
        row = spark.read.parquet(f"{out}/set").collect()
        assert len(row) == 1 and sorted([row[0]["negative_0"], row[0]["negative_1"]]) == ["beta one", "gamma one"] and row[0]["negative_2"] == ""
        assert spark.read.parquet(f"{out}/kd/documents").count() == 3
    published = spark.read.parquet(f"{out}/set_kd/config=documents_set-go/dataset=Org%2FSet/lang=go")
    assert published.columns == ["document_id", "document", "split"]
    assert "query_id" not in spark.read.parquet(f"{out}/set").columns


def test_report_says_what_a_limit_leaves_out(spark, tmp_path):
    rows = [(f"question {i}", f"answer {i}") for i in range(9)]
    spark.createDataFrame(rows, "q string, d string").write.parquet(f"{tmp_path}/Org/P/train")
    spec = Dataset("Org/P", ["go"], query_field="q", documents_field="d")
    mining = Mining(4, 2, encode=encode.hashed_encoder(16))
    report = run_job(spark, str(tmp_path), [spec], mining, Output(str(tmp_path / "o"), "kd", max_per_language=4)).first()
    assert (report["queries_available"], report["queries"]) == (9, 4)
    assert run_job(spark, str(tmp_path), [spec], mining, Output(str(tmp_path / "p"), "kd")).first()["queries"] == 9


def test_a_column_called_pos_is_no_position(spark, tmp_path):
    spark.createDataFrame([("NOUN", "a"), ("VERB", "b")], "pos string, d string").coalesce(1).write.parquet(f"{tmp_path}/t")
    assert as_set(read_table(spark, f"{tmp_path}/t"), "pos", "source_pos", "d") == {(0, "NOUN", "a"), (1, "VERB", "b")}
    spark.createDataFrame([(7, "a")], "at int, d string").write.json(f"{tmp_path}/j")
    assert as_set(read_table(spark, f"{tmp_path}/j", "json", pos_field="at"), "pos", "d") == {(7, "a")}
    with pytest.raises(ValueError):
        read_table(spark, f"{tmp_path}/j", "json", pos_field="pos")


def test_published_shape_without_folders(spark, tmp_path):
    """Plain tables as they are published: no dataset, language or position column."""
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs = [("a", "t1", "x"), ("b", "t2", "x"), ("c", "t1", "x")]
    spark.createDataFrame(docs, "document_id string, document string, split string").coalesce(1).write.parquet(f"{root}/config=documents_p")
    scores = spark.createDataFrame([("q", ["c", "b", "a"], [0.9, 0.8, 0.7], "x")], "query_id string, document_ids array<string>, scores array<double>, split string")
    scores.write.parquet(f"{root}/config=scores_p")
    # A target that can be read and fails: the others land in the same folders as ever.
    spark.range(1).write.parquet(f"{root}/config=documents_bad")
    spark.range(1).write.parquet(f"{root}/config=scores_bad")
    report = {r["target"]: r for r in dedup_published(spark, root, out, ("bad", "p")).collect()}
    assert (report["p"]["status"], report["p"]["removed"], report["bad"]["status"]) == ("changed", 1, "failed")
    assert "document_id" in report["bad"]["error"]
    assert sorted(p.name for p in (tmp_path / "out").glob("*=*")) == ["config=documents_p", "config=scores_p"]
    got = spark.read.parquet(f"{out}/config=documents_p")
    assert got.columns == ["document_id", "document", "split"] and as_set(got, "document_id") == {("a",), ("b",)}
    assert spark.read.parquet(f"{out}/config=scores_p").first()["document_ids"] == ["a", "b"]


def test_late_interaction_is_bounded_by_tokens(spark, monkeypatch):
    """Small products, with and without a broadcast, give the same scores."""
    text = lambda n: " ".join(f"w{int(i)}" for i in RNG.integers(0, 50, n))
    asked = spark.createDataFrame([("s", "x", f"q{i}", text(6)) for i in range(6)], K + "query_id string, query string")
    docs = spark.createDataFrame([("s", "x", f"d{i}", text(int(RNG.integers(1, 40)))) for i in range(40)], K + "document_id string, document string")
    coder = encode.hashed_token_encoder({"query": 4, "document": 30})
    want = ranks(retrieve(asked, docs, 5, "late_interaction", coder, pruned=False))
    q, d = coder(asked, "query"), coder(docs, "document")
    assert q.agg(F.max(F.size("tokens"))).first()[0] <= 4
    monkeypatch.setattr(MaxSim, "cells", 64)
    monkeypatch.setattr(late, "WANTED", 2)
    assert ranks(late.maxsim_topk(q, d, 5)) == want
    for limit in (1 << 28, 0):
        assert ranks(late.plaid_topk(q, d, 5, nlist=4, nprobe=4, full_scores=40, broadcast_bytes=limit)) == want


def test_token_model_knows_its_side(spark):
    def load(mode):
        return lambda texts: [[[float(len(w)), 1.0 if mode == "query" else 2.0] for w in t.split()] for t in texts]

    coder = encode.model_token_encoder(load, 2)
    rows = spark.createDataFrame([("a bb",), (None,), ("ccc",)], "query string")
    assert [r["tokens"] for r in coder(rows.coalesce(1), "query").collect()] == [[[1.0, 1.0], [2.0, 1.0]], [], [[3.0, 1.0]]]
    assert coder(rows.withColumnRenamed("query", "document").coalesce(1), "document").first()["tokens"][0] == [1.0, 2.0]


def test_buckets_prune_clustered_vectors(spark):
    centres = RNG.normal(size=(40, 16)) * 4
    points = np.repeat(centres, 25, axis=0) + RNG.normal(size=(1000, 16)) * 0.3
    d = vectors(spark, [(f"d{i}", v) for i, v in enumerate(points)], "document_id")
    q = vectors(spark, [(f"q{i}", v) for i, v in enumerate(points[::20])], "query_id")
    for metric in ("cosine", "l2", "ip"):
        planes, center = cells.random_planes(8, 6, 16, 1), cells.centers(d, metric)
        found, exact = cells.lsh_topk(q, d, 10, metric, flips=1, planes=planes, center=center), knn(q, d, 10, metric)
        common = found.join(exact, ["query_id", "document_id", "score"]).count()
        assert common >= (0.9 if metric != "ip" else 0.6) * exact.count()
        assert cells.scored_share(*cells.bucketed(q, d, planes, center, metric, 1)).first()["share"] < 0.5
