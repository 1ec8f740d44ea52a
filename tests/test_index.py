"""Saved indexes: appended to, read where a search looks, reachable from a job."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.operators import encode, index as I, late, residual
from negsift.operators.retrieve import knn, retrieve
from negsift.plans.job import run_job
from negsift.plans.params import Dataset, Mining, Output
from rows import K, as_set
from test_graph import clustered, rows


def ranks(found):
    return as_set(found, "query_id", "document_id", "rank")


def tokens(spark, texts, id_col, lang="x"):
    lists = [("s", lang, f"{id_col[0]}{i}", [[float(x) for x in v] for v in t]) for i, t in enumerate(texts)]
    return spark.createDataFrame(lists, K + f"{id_col} string, tokens array<array<float>>")


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_appended_equals_whole(spark, tmp_path, metric):
    points = np.random.default_rng(1).normal(size=(300, 8))
    d, q = rows(spark, points, "document_id"), rows(spark, points[:20], "query_id")
    path = str(tmp_path / "i")
    number = F.substring("document_id", 2, 9).cast("int")
    I.build_index(d.filter(number < 200), path, metric=metric, nlist=6)
    assert I.append_index(d.filter(number >= 150), path) == 100  # 150 to 199 are there
    assert I.append_index(d, path) == 0
    assert ranks(I.search_index(q, path, 7, nprobe=6)) == ranks(knn(q, d, 7, metric))
    report = I.index_report(spark, path).orderBy("at").collect()
    assert [r["documents"] for r in report] == [200, 100] and report[0]["drift"] == 1.0 and 0.8 < report[1]["drift"] < 1.25


def test_drift_tells_other_documents(spark, tmp_path):
    rng = np.random.default_rng(2)
    first, path = rows(spark, clustered(rng, 5, 40), "document_id"), str(tmp_path / "i")
    I.build_index(first, path, metric="l2", nlist=5)
    later = rows(spark, clustered(rng, 5, 20), "document_id").withColumn("document_id", F.concat(F.lit("n"), "document_id"))
    I.append_index(later, path)
    assert I.index_report(spark, path).agg(F.max("drift")).first()[0] > 2


def test_only_probed_cells_are_read(spark, tmp_path):
    points = clustered(np.random.default_rng(3), 10, 30)
    path = str(tmp_path / "i")
    I.build_index(rows(spark, points, "document_id"), path, metric="l2", nlist=10)
    saved = I.Saved(spark, path)
    asked = spark.createDataFrame([("s", "x", 2), ("s", "x", 7)], "dataset string, lang string, cell int")
    files = {os.path.dirname(f).rsplit("cell=", 1)[1] for f in saved.documents(asked).inputFiles()}
    # inputFiles lists what the relation has; the plan says what is read of it.
    plan = saved.documents(asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert saved.documents(asked).select("cell").distinct().count() == 2 <= len(files)


def test_a_failed_append_is_not_read(spark, tmp_path):
    points = np.random.default_rng(4).normal(size=(100, 4))
    path = str(tmp_path / "i")
    I.build_index(rows(spark, points, "document_id"), path, nlist=3)
    stray = os.path.join(path, "segments", "segment=stray", "dataset=s", "lang=x", "cell=0")
    os.makedirs(stray)
    rows(spark, points[:5], "document_id").select("document_id").coalesce(1).write.mode("append").parquet(stray)
    assert I.Saved(spark, path).documents().count() == 100


def test_codes_and_kinds(spark, tmp_path):
    points = np.random.default_rng(5).normal(size=(120, 8))
    d, q = rows(spark, points, "document_id"), rows(spark, points[:10], "query_id")
    I.build_index(d.limit(0).unionByName(d), str(tmp_path / "p"), "ivfpq", nlist=3, m=4)
    found = I.search_index(q, str(tmp_path / "p"), 5, nprobe=3)
    assert found.count() == 50 and found.filter("rank = 1 and substring(query_id, 2) = substring(document_id, 2)").count() >= 9
    with pytest.raises(ValueError):
        I.build_index(d, str(tmp_path / "x"), "tree")


def test_residuals(spark, tmp_path):
    """Clustered tokens: nine of ten neighbours, scores of what is read back, few documents opened."""
    rng = np.random.default_rng(6)
    kinds = rng.normal(size=(40, 16))
    kinds /= np.linalg.norm(kinds, axis=1, keepdims=True)
    text = lambda n: kinds[rng.choice(40, n)] + rng.normal(size=(n, 16)) * 0.05
    d = [text(int(rng.integers(3, 9))) for _ in range(400)]
    q = [np.vstack([x[:3], text(1)]) for x in d[::20]]
    corpus, queries = tokens(spark, d, "document_id").cache(), tokens(spark, q, "query_id").cache()
    whole = late.maxsim_topk(queries, corpus, 10)
    compact = residual.compress(corpus, residual.train_codec(corpus, 40, 4))
    found = residual.residual_topk(queries, compact, 10, nprobe=2, keep=80)
    assert found.select("query_id", "document_id").join(whole, ["query_id", "document_id"]).count() >= 0.9 * 200
    assert residual.residual_topk(queries, compact, 10, nprobe=2, keep=80, broadcast_bytes=0).count() == 200
    exact = whole.select("query_id", "document_id", F.col("score").alias("exact"))
    worst = found.join(exact, ["query_id", "document_id"]).agg(F.max(F.abs(F.col("score") - F.col("exact")))).first()[0]
    assert worst < 0.2  # of four tokens together
    # Each token is read back near itself, nearer with more bits.
    off = []
    for bits in (1, 2, 4, 8):
        codec = residual.train_codec(corpus, 40, bits, centroids=compact.codec.centroids)
        packed = residual.compress(corpus, codec).documents
        row = packed.withColumn("tokens", residual.opened(packed, codec)).filter("document_id = 'd7'").first()
        assert len(row["packed"]) == len(d[7]) * 2 * bits and np.shape(row["tokens"]) == d[7].shape
        off.append(np.abs(np.array(row["tokens"]) - d[7].astype(np.float32)).max())
    assert off == sorted(off, reverse=True) and off[-1] < 0.05
    assert residual.residual_topk(queries, compact, 10, least=2.0).count() == 0  # no token is so near a centroid
    with pytest.raises(ValueError):
        residual.train_codec(corpus, 40, 3)


def test_saved_late_interaction(spark, tmp_path):
    rng = np.random.default_rng(7)
    d = [rng.normal(size=(int(rng.integers(0, 6)), 8)) for _ in range(80)]
    corpus, queries = tokens(spark, d, "document_id"), tokens(spark, [x[:2] for x in d[::9]], "query_id")
    path = str(tmp_path / "i")
    I.build_index(corpus.limit(50), path, "plaid", nlist=6)
    I.append_index(corpus, path)
    saved = I.Saved(spark, path)
    compact = residual.compress(corpus.filter("size(tokens) > 0"), saved.codec)
    want = ranks(residual.residual_topk(queries, compact, 5, nprobe=3, keep=30))
    assert ranks(I.search_index(queries, path, 5, nprobe=3, keep=30)) == want


def test_job_searches_a_saved_index(spark, tmp_path):
    """The job with an index finds what it finds without, and its documents are not encoded."""
    root, coder = str(tmp_path / "in"), encode.hashed_encoder(32)
    pairs = [(f"alpha w{i} question", f"alpha w{i} body w{i % 5}") for i in range(60)]
    spark.createDataFrame(pairs, "q string, d string").coalesce(1).write.parquet(f"{root}/Org/P/train")
    spec = Dataset("Org/P", ["go"], query_field="q", documents_field="d")

    def queries_only(frame, column):
        assert column == "query"
        return coder(frame, column)

    run_job(spark, root, [spec], Mining(6, 3, encode=coder), Output(str(tmp_path / "a"), "kd"))
    from negsift.plans.load import load_dataset

    path = str(tmp_path / "index")
    I.build_index(coder(load_dataset(spark, root, spec).corpus, "document"), path, nlist=4)
    search = {"index": path, "nprobe": 4}
    run_job(spark, root, [spec], Mining(6, 3, encode=queries_only, search=search), Output(str(tmp_path / "b"), "kd"))
    a, b = (spark.read.parquet(f"{tmp_path}/{x}/kd/scores") for x in "ab")
    assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count() == 60
    hits = retrieve(load_dataset(spark, root, spec).queries, None, 3, encode=coder, index=path, nprobe=4)
    assert hits.count() == 180
