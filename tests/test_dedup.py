from pyspark.sql import functions as F

from negsift.operators.dedup import (
    canonical_ids, corpus_id_conflicts, dedup_bundle, dedup_corpus, dedup_report, group_qrels, id_map, remap_qrels,
    remap_scores, resolve_id_conflicts,
)
from negsift.plans.posthoc import dedup_published
from negsift.schema import Bundle, KEYS
from rows import K, as_set, corpus, qrels, queries

COPIES = {"a": "t1", "b": "t2", "c": "t1", "d": "t1", "e": "t3", "f": "t2"}


def test_first_seen_wins(spark):
    docs = corpus(spark, COPIES).repartition(5)
    assert as_set(dedup_corpus(docs), "document_id", "document", "pos") == {("a", "t1", 0), ("b", "t2", 1), ("e", "t3", 4)}
    assert as_set(id_map(docs), "document_id", "canonical_id") == {
        ("a", "a"), ("b", "b"), ("c", "a"), ("d", "a"), ("e", "e"), ("f", "b"),
    }


def test_hot_texts_take_the_other_path(spark):
    docs = corpus(spark, {f"d{i}": "hot" if i % 3 else f"t{i}" for i in range(60)})
    assert as_set(id_map(docs, hot_rows=5), "document_id", "canonical_id") == as_set(id_map(docs), "document_id", "canonical_id")
    assert as_set(dedup_corpus(docs, hot_rows=5), "document_id") == as_set(dedup_corpus(docs), "document_id")
    judged = qrels(spark, [(f"q{i}", "d2") for i in range(30)] + [("q1", "d3"), ("q2", "gone")])
    assert as_set(remap_qrels(judged, id_map(docs), hot_rows=5), "query_id", "document_id") == as_set(
        remap_qrels(judged, id_map(docs)), "query_id", "document_id"
    ) == {(f"q{i}", "d1") for i in range(30)} | {("q1", "d3"), ("q2", "gone")}


def test_idempotent(spark):
    once = dedup_corpus(corpus(spark, COPIES))
    assert as_set(dedup_corpus(once), "document_id") == as_set(once, "document_id")


def test_languages_stay_apart(spark):
    docs = corpus(spark, {"a": "same"}, "x").unionByName(corpus(spark, {"b": "same"}, "y"))
    assert dedup_corpus(docs).count() == 2


def test_qrels_follow(spark):
    docs = corpus(spark, COPIES)
    judged = qrels(spark, [("q", "d"), ("q", "e"), ("q", "c"), ("q", "a"), ("q", "zz"), ("r", "f")])
    bundle = dedup_bundle(Bundle(queries(spark, ["q", "r"]), docs, judged))
    assert as_set(
        group_qrels(bundle.qrels).withColumn("document_ids", F.array_join("document_ids", " ")), "query_id", "document_ids"
    ) == {("q", "a e zz"), ("r", "b")}


def test_id_conflicts(spark):
    docs = corpus(spark, [("a", "t1"), ("b", "t2"), ("a", "t2"), ("c", "t3"), ("c", "t3")])
    assert as_set(corpus_id_conflicts(docs), "document_id", "texts", "rows") == {("a", 2, 2)}
    # The last mapping of an id wins, and so does its last text.
    assert as_set(id_map(docs), "document_id", "canonical_id") == {("a", "b"), ("b", "b"), ("c", "c")}
    for hot in (1_000_000, 2):
        assert as_set(resolve_id_conflicts(docs, hot_rows=hot), "document_id", "document", "pos") == {
            ("a", "t2", 2), ("b", "t2", 1), ("c", "t3", 4),
        }


def _scores(spark, rows):
    return spark.createDataFrame(
        [("s", "x", q, d, [float(v) for v in s], "x") for q, d, s in rows],
        K + "query_id string, document_ids array<string>, scores array<double>, split string",
    )


def test_score_lists_keep_first(spark):
    mapping = id_map(corpus(spark, COPIES))
    scores = _scores(spark, [("q1", ["c", "b", "a", "f", "e"], [-1, 0.9, 0.8, 0.7, 0.6]), ("q2", [], []), ("q3", ["zz"], [0.5])])
    for hot in (1_000_000, 1):
        got = {r["query_id"]: (r["document_ids"], r["scores"]) for r in remap_scores(scores, mapping, hot_rows=hot).collect()}
        # The unretrieved positive c becomes a and swallows the retrieved copy.
        assert got == {"q1": (["a", "b", "e"], [-1.0, 0.9, 0.6]), "q2": ([], []), "q3": (["zz"], [0.5])}


def test_report(spark):
    row = dedup_report(corpus(spark, COPIES)).first()
    assert (row["before"], row["after"], row["removed"], row["pct"], row["ids_remapped"]) == (6, 3, 3, 50.0, 3)
    assert canonical_ids(corpus(spark, COPIES)).agg(F.sum("copies")).first()[0] == 6


def _publish(spark, root, target, texts, scores):
    docs = corpus(spark, texts).withColumn("split", F.lit("x"))
    docs.write.partitionBy(*KEYS).parquet(f"{root}/config=documents_{target}")
    scores.write.partitionBy(*KEYS).parquet(f"{root}/config=scores_{target}")


def test_published_targets(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    _publish(spark, root, "copies", COPIES, _scores(spark, [("q", ["c", "a"], [0.9, 0.8])]))
    _publish(spark, root, "clean", {"a": "t1"}, _scores(spark, [("q", ["a"], [0.9])]))
    targets = ("copies", "clean", "absent")
    dry = dedup_published(spark, root, out, targets, dry_run=True)
    assert as_set(dry, "target", "status", "removed") == {
        ("copies", "would change", 3), ("clean", "no duplicates", 0), ("absent", "failed", None),
    }
    assert not (tmp_path / "out").exists()
    done = dedup_published(spark, root, out, targets)
    assert as_set(done, "target", "status") == {("copies", "changed"), ("clean", "no duplicates"), ("absent", "failed")}
    assert sorted(p.name for p in (tmp_path / "out").glob("config=*")) == ["config=documents_copies", "config=scores_copies"]
    assert spark.read.parquet(f"{out}/config=documents_copies").count() == 3
    assert spark.read.parquet(f"{out}/config=scores_copies").first()["document_ids"] == ["a"]


def test_bad_target_does_not_stop_the_rest(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    _publish(spark, root, "copies", COPIES, _scores(spark, [("q", ["c", "a"], [0.9, 0.8])]))
    # Readable, but without the column that the dedup needs.
    spark.range(1).selectExpr("'s' dataset", "'x' lang", "id").write.partitionBy(*KEYS).parquet(f"{root}/config=documents_bad")
    spark.range(1).selectExpr("'s' dataset", "'x' lang", "id").write.partitionBy(*KEYS).parquet(f"{root}/config=scores_bad")
    done = dedup_published(spark, root, out, ("bad", "copies"))
    assert as_set(done, "target", "status") == {("copies", "changed"), ("bad", "failed")}


def test_texts_stay_where_they_are_read(spark):
    """Positions as bitmaps: the same rows as a join, and no exchange that carries the texts."""
    from negsift.operators import formats
    from negsift.operators.positions import by_position

    rng = range(0, 200_000, 7)
    frame = spark.createDataFrame([("s", "xy"[i % 2], f"d{i}", f"text {i % 900}", i - 3000) for i in rng], K + "document_id string, document string, pos long").repartition(6)
    some = frame.filter("pmod(hash(document_id), 3) = 0").select(*KEYS, "pos")
    for keep in (True, False):
        got = by_position(frame, some, keep)
        assert got.columns == frame.columns
        for limit in (1 << 28, 0):
            assert as_set(by_position(frame, some, keep, map_bytes=limit), *KEYS, "pos") == as_set(frame.join(some, [*KEYS, "pos"], "left_semi" if keep else "left_anti"), *KEYS, "pos")
    used = frame.filter("pmod(hash(document_id), 5) = 0").select(*KEYS, "document_id", (F.col("pos") * 0).alias("place"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows in (dedup_corpus(frame), formats.kd_documents(frame, used)):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
            assert not any("document#" in line for line in exchanges) and "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert formats.kd_documents(frame, used).count() == used.count()
