import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.functions.vectors import hashed_counts, l2_normalize
from negsift.operators import cells, encode, late
from negsift.operators.retrieve import knn, recall, retrieve
from negsift.operators.topk import topk
from negsift.schema import KEYS
from rows import K, as_set, vectors

RNG = np.random.default_rng(7)


def _data(spark, nq=40, nd=300, dim=16, lang="x"):
    q = RNG.normal(size=(nq, dim)).astype(np.float32)
    d = RNG.normal(size=(nd, dim)).astype(np.float32)
    d[10:20] = d[5]  # copies tie
    queries = vectors(spark, [(f"q{i}", v) for i, v in enumerate(q)], "query_id", lang)
    corpus = vectors(spark, [(f"d{i}", v) for i, v in enumerate(d)], "document_id", lang)
    return q.astype(float), d.astype(float), queries, corpus


def _scores(q, d, metric):
    if metric == "cosine":
        return (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (d / np.linalg.norm(d, axis=1, keepdims=True)).T
    return q @ d.T if metric == "ip" else -((q[:, None] - d[None]) ** 2).sum(2)


def _brute(q, d, k, metric):
    s = np.round(_scores(q, d, metric), 9)
    return {
        (f"q{i}", f"d{j}", r + 1)
        for i in range(len(q))
        for r, j in enumerate(sorted(range(len(d)), key=lambda j: (-s[i, j], f"d{j}"))[:k])
    }


def _ranks(hits):
    return as_set(hits, "query_id", "document_id", "rank")


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_both_forms_equal_brute_force(spark, metric):
    q, d, queries, corpus = _data(spark)
    want = _brute(q, d, 15, metric)
    assert _ranks(knn(queries, corpus, 15, metric)) == want
    assert _ranks(knn(queries, corpus, 15, metric, form="broadcast", doc_block=37)) == want
    assert _ranks(knn(queries, corpus, 15, metric, form="blocks", doc_block=40, query_block=11)) == want
    assert _ranks(knn(queries.repartition(3), corpus.repartition(6), 15, metric, broadcast_bytes=0)) == want


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_many_chunks_in_one_task(spark, metric):
    """Later chunks send only what can still be among the best."""
    q, d, queries, corpus = _data(spark, nd=400)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    try:
        hits = knn(queries, corpus.coalesce(1), 6, metric, form="broadcast", doc_block=25)
        assert _ranks(hits) == _brute(q, d, 6, metric)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_fewer_documents_than_k(spark):
    q, d, queries, corpus = _data(spark, 3, 25)
    for form in ("broadcast", "blocks"):
        assert _ranks(knn(queries, corpus, 100, form=form)) == _brute(q, d, 100, "cosine")


def test_languages_search_their_own_corpus(spark):
    q, d, queries, corpus = _data(spark, 5, 60)
    q2, d2, queries2, corpus2 = _data(spark, 4, 50, lang="y")
    for form in ("broadcast", "blocks"):
        hits = knn(queries.unionByName(queries2), corpus.unionByName(corpus2), 5, form=form, doc_block=16)
        assert _ranks(hits.filter("lang = 'x'")) == _brute(q, d, 5, "cosine")
        assert _ranks(hits.filter("lang = 'y'")) == _brute(q2, d2, 5, "cosine")


def test_zero_vectors_and_empty_sides(spark):
    queries = vectors(spark, [("q", [0, 0])], "query_id")
    corpus = vectors(spark, [("b", [1, 0]), ("a", [0, 0])], "document_id")
    for form in ("broadcast", "blocks"):
        assert as_set(knn(queries, corpus, 5, form=form), "document_id", "score", "rank") == {("a", 0.0, 1), ("b", 0.0, 2)}
        assert knn(queries.limit(0), corpus, 5, form=form).count() == 0
        assert knn(queries, corpus.limit(0), 5, form=form).count() == 0


def test_errors(spark):
    _, _, queries, corpus = _data(spark, 2, 12)
    for wrong in ({"metric": "dot"}, {"method": "tree"}, {"form": "other"}):
        with pytest.raises(ValueError):
            knn(queries, corpus, 3, **wrong)
    with pytest.raises(ValueError):
        retrieve(queries, corpus, 3, architecture="other")
    with pytest.raises(Exception, match="number of dimensions"):
        knn(vectors(spark, [("q", [1, 2])], "query_id"), corpus, 3).count()
    with pytest.raises(Exception, match="number of dimensions"):
        knn(queries, vectors(spark, [("a", [1, 2]), ("b", [1])], "document_id"), 3).count()


def test_cell_count():
    assert [cells.cell_count(100, n) for n in (5, 10, 99, 500, 10_000)] == [1, 1, 9, 50, 100]


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_all_cells_are_exact(spark, metric):
    q, d, queries, corpus = _data(spark)
    want = _brute(q, d, 9, metric)
    assert _ranks(knn(queries, corpus, 9, metric, method="ivf", nlist=6, nprobe=6)) == want
    assert _ranks(knn(queries, corpus, 9, metric, method="ivf", nlist=6, nprobe=6, form="blocks", doc_block=20)) == want


def test_tiny_corpus_has_one_cell(spark):
    q, d, queries, corpus = _data(spark, 3, 21)
    corpus, d = corpus.filter("document_id in ('d0', 'd1', 'd2')"), d[:3]
    assert _ranks(knn(queries, corpus, 2, method="ivf", nlist=100)) == _brute(q, d, 2, "cosine")


def test_saved_index(spark, tmp_path):
    q, d, queries, corpus = _data(spark)
    centroids = cells.train_cells(corpus, 6)
    celled = cells.with_cell(corpus, centroids)
    cells.save_index(celled, centroids, str(tmp_path), rows_per_file=20)
    read, back, books = cells.load_index(spark, str(tmp_path))
    assert read.count() == 300 and np.allclose(back["s", "x"], centroids["s", "x"]) and books == {}
    assert _ranks(cells.ivf_topk(queries, read, back, 7, nprobe=2)) == _ranks(cells.ivf_topk(queries, celled, centroids, 7, nprobe=2))


def test_saved_codes(spark, tmp_path):
    _, _, queries, corpus = _data(spark)
    index = cells.build_codes(corpus, nlist=6, m=4)
    cells.save_index(index[0], index[1], str(tmp_path), index[2])
    read = cells.load_index(spark, str(tmp_path))
    assert "embedding" not in read[0].columns
    assert _ranks(cells.ivfpq_topk(queries, *read, 7, nprobe=3)) == _ranks(cells.ivfpq_topk(queries, *index, 7, nprobe=3))


def _recall(hits, exact, k):
    return recall(hits, exact, k).first()["recall"]


def test_recall_of_codes_and_hashes(spark, sf):
    from checks.search_queries import exact

    whole = exact(spark, sf).persist()
    assert _recall(whole, whole, 10) == 1.0
    assert _recall(exact(spark, sf, method="ivf", nlist=16, nprobe=8), whole, 10) >= 0.75
    assert _recall(exact(spark, sf, method="ivfpq", nlist=16, nprobe=16, m_pq=8), whole, 10) >= 0.6
    assert _recall(exact(spark, sf, method="lsh"), whole, 10) >= 0.95
    assert _recall(exact(spark, sf, method="hnsw"), whole, 10) >= 0.95
    whole.unpersist()


def test_codes_with_l2_and_few_rows(spark):
    _, _, queries, corpus = _data(spark, 5, 60)
    exact = knn(queries, corpus, 5, "l2")
    # With a code per document nothing is lost.
    assert _recall(knn(queries, corpus, 5, "l2", method="ivfpq", nlist=2, nprobe=2, m_pq=4), exact, 5) >= 0.8
    with pytest.raises(ValueError):
        knn(queries, corpus, 5, method="ivfpq", nlist=2, m_pq=3)


def _maxsim_data(spark):
    sizes_q, sizes_d = RNG.integers(1, 5, 12), RNG.integers(0, 9, 70)
    q = [RNG.normal(size=(n, 8)) for n in sizes_q]
    d = [RNG.normal(size=(n, 8)) for n in sizes_d]

    def rows(prefix, texts, id_col):
        return spark.createDataFrame(
            [("s", "x", f"{prefix}{i}", [[float(x) for x in v] for v in t]) for i, t in enumerate(texts)],
            K + f"{id_col} string, tokens array<array<float>>",
        )

    as32 = lambda texts: [t.astype(np.float32).astype(float) for t in texts]
    return as32(q), as32(d), rows("q", q, "query_id"), rows("d", d, "document_id")


def _maxsim_brute(q, d, k):
    score = lambda a, b: round(float((a @ b.T).max(1).sum()), 9) if len(b) else 0.0
    return {
        (f"q{i}", f"d{j}", r + 1)
        for i, a in enumerate(q)
        for r, j in enumerate(sorted(range(len(d)), key=lambda j: (-score(a, d[j]), f"d{j}"))[:k])
    }


def test_maxsim_ragged(spark):
    q, d, queries, corpus = _maxsim_data(spark)
    want = _maxsim_brute(q, d, 6)
    assert _ranks(late.maxsim_topk(queries, corpus, 6)) == want
    assert _ranks(late.maxsim_topk(queries, corpus, 6, form="blocks", doc_block=9, query_block=5)) == want
    small = late.MaxSim()
    small.cells = 40  # goes to the tasks with the scorer
    assert _ranks(topk(queries, corpus, 6, small)) == want


def test_plaid_at_its_limit_is_exact(spark):
    q, d, queries, corpus = _maxsim_data(spark)
    kept = corpus.filter("size(tokens) > 0")  # no token, no centroid, no candidate
    exact = _ranks(late.maxsim_topk(queries, kept, 6))
    assert _ranks(late.plaid_topk(queries, kept, 6, nlist=5, nprobe=5, full_scores=None)) == exact
    assert _ranks(late.plaid_topk(queries, kept, 6, nlist=5, nprobe=5, full_scores=70)) == exact
    assert _ranks(late.plaid_topk(queries, kept, 6, nlist=5, nprobe=5, full_scores=70, broadcast_bytes=0)) == exact
    assert _ranks(retrieve(queries, kept, 6, architecture="late_interaction", pruned=False)) == exact


def test_normalize(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>").select(
        l2_normalize(F.col("a")).alias("a"), l2_normalize(F.col("z")).alias("z")
    ).first()
    assert row["a"] == [0.6, 0.8] and row["z"] == [0.0, 0.0]


def test_hashed_counts(spark):
    import hashlib

    texts = ["The  the cat\n", "", None, " \t", "a b c d a", "É é"]
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % 8
    for limit in (0, 1, 2, 4):
        want = {}
        for i, text in enumerate(texts):
            row = [0.0] * 8
            words = (text or "").lower().split()
            for word in words[:limit] if limit else words:
                row[bucket(word)] += 1
            want[i] = row
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
        assert {r["i"]: r["v"] for r in rows.select("i", hashed_counts(F.col("t"), 8, limit).alias("v")).collect()} == want


def test_job_retriever_is_pluggable(spark, tmp_path):
    from negsift.plans.job import run_job
    from negsift.plans.params import Dataset, Mining, Output

    root = str(tmp_path / "in")
    rows = [(f"alpha beta w{i}", f"alpha w{i} body") for i in range(12)]
    spark.createDataFrame(rows, "q string, d string").coalesce(1).write.parquet(f"{root}/Org/Pairs/train")

    def first_documents(queries, corpus, k, architecture, encode, **search):
        """Every query gets the first documents in source order."""
        top = corpus.orderBy("pos").limit(k).select(*KEYS, "document_id", "pos")
        return queries.select(*KEYS, "query_id").join(top, KEYS).select(
            *KEYS, "query_id", "document_id", (1 / (F.col("pos") + 1)).alias("score"), (F.col("pos") + 1).cast("int").alias("rank")
        )

    spec = Dataset("Org/Pairs", ["go"], query_field="q", documents_field="d")
    report = run_job(spark, root, [spec], Mining(4, 2, retriever=first_documents), Output(str(tmp_path / "a"), max_per_query=2))
    row = report.first()
    assert (row["queries"], row["results"], row["positives_not_retrieved"], row["valid"]) == (12, 12, 8, 4)
    assert spark.read.parquet(str(tmp_path / "a/contrastive")).count() == 4
    kd = spark.read.parquet(str(tmp_path / "a/kd/scores"))
    assert kd.count() == 12 and set(kd.columns) >= {"query_id", "document_ids", "scores", "split"}

    none = run_job(spark, root, [spec], Mining(4, 2, encode=encode.hashed_encoder(16)), Output(str(tmp_path / "b"), "kd", max_per_language=3))
    assert none.first()["queries"] == 3 and not (tmp_path / "b/contrastive").exists()
    with pytest.raises(ValueError):
        run_job(spark, root, [spec], Mining(), Output(str(tmp_path / "c"), "other"))


def test_job_searches(spark, tmp_path):
    """Every kind of search through the job, and two datasets of one language."""
    from negsift.plans.job import run_job
    from negsift.plans.params import Dataset, Mining, Output

    root = str(tmp_path / "in")
    words = ["red", "blue", "green", "round", "square", "small", "large", "old", "new", "warm"]
    pick = lambda i, n: " ".join(words[(i * s + 3 * s) % 10] for s in range(1, n))
    for name in ("Org/A", "Org/B"):
        rows = [(f"{pick(i, 4)} {name} {i}", f"{pick(i, 7)} {name} {i}") for i in range(40)]
        spark.createDataFrame(rows, "q string, d string").coalesce(1).write.parquet(f"{root}/{name}/train")
    specs = [Dataset(name, ["go"], query_field="q", documents_field="d") for name in ("Org/A", "Org/B")]
    plain = encode.hashed_encoder(32)
    tokens = lambda rows, text: encode.token_matrix(plain(rows, text), 4, 8)
    for i, mining in enumerate(
        [
            Mining(10, 5, encode=plain, search={"method": "ivf", "nlist": 2, "nprobe": 2}),
            Mining(10, 5, encode=plain, search={"method": "ivfpq", "nlist": 2, "nprobe": 2, "m_pq": 4}),
            Mining(10, 5, encode=plain, search={"method": "hnsw", "graph_degree": 4}),
            Mining(10, 5, encode=plain, search={"method": "lsh", "hash_bits": 2}),
            Mining(10, 5, encode=plain, search={"method": "ivf_exact", "nlist": 2}),
            Mining(10, 5, encode=plain, search={"metric": "l2"}),
            Mining(10, 5, "late_interaction", tokens, {"nlist": 8}),
            Mining(10, 5, "late_interaction", tokens, {"pruned": False}),
        ]
    ):
        out = str(tmp_path / f"out{i}")
        report = run_job(spark, root, specs, mining, Output(out, name="set", max_per_query=5))
        assert as_set(report, *KEYS, "queries", "results") == {("Org/A", "go", 40, 40), ("Org/B", "go", 40, 40)}
        scores = spark.read.parquet(f"{out}/kd/scores")
        assert scores.groupBy("dataset").count().count() == 2
        # Each dataset searched its own corpus.
        documents = spark.read.parquet(f"{out}/set_kd/config=documents_go")
        assert documents.filter(~F.contains("document", "dataset")).count() == 0
        wide = spark.read.parquet(f"{out}/contrastive")
        assert wide.count() == report.agg(F.sum("valid")).first()[0] > 0 and "negative_4_score" in wide.columns
