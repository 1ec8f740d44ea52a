import pytest
from pyspark.sql import functions as F

from negsift.operators import formats, mine
from rows import as_set, corpus, hits, qrels, queries

DOCS = {d: f"text {d}" for d in "abcdefg"}


def _entries(spark, found, judged, asked=("q",), n=100, **options):
    return mine.mined_entries(queries(spark, list(asked)), hits(spark, found), qrels(spark, judged), n, **options)


def _list(entries, query="q"):
    rows = entries.filter(F.col("query_id") == query).orderBy("place").collect()
    return [(r["document_id"], r["score"]) for r in rows]


FOUND = [("q", "a", 0.9), ("q", "b", 0.8), ("q", "c", 0.7), ("q", "d", 0.6)]


def test_positive_first(spark):
    assert _list(_entries(spark, FOUND, [("q", "c")])) == [("c", 0.7), ("a", 0.9), ("b", 0.8), ("d", 0.6)]


def test_positive_not_retrieved(spark):
    assert _list(_entries(spark, FOUND, [("q", "z")], n=2)) == [("z", -1.0), ("a", 0.9), ("b", 0.8)]


def test_some_of_several_retrieved(spark):
    judged = [("q", "z"), ("q", "c"), ("q", "y"), ("q", "a"), ("q", "a")]
    assert _list(_entries(spark, FOUND, judged, n=1)) == [("a", 0.9), ("c", 0.7), ("y", -1.0), ("z", -1.0), ("b", 0.8)]


def test_no_positive_and_no_hits(spark):
    entries = _entries(spark, FOUND + [("r", "a", 0.5)], [("q", "a"), ("s", "b"), ("other", "a")], asked=("q", "r", "s"))
    assert as_set(entries, "query_id") == {("q",), ("s",)}
    assert _list(entries, "s") == [("b", -1.0)]
    report = mine.mining_report(queries(spark, ["q", "r", "s"]), entries).first()
    assert (report["queries"], report["results"], report["skipped"], report["positives_not_retrieved"]) == (3, 2, 1, 1)


def test_all_skipped(spark):
    entries = _entries(spark, FOUND, [("other", "a")])
    assert entries.count() == 0
    assert mine.mining_report(queries(spark, ["q"]), entries).first()["skipped"] == 1


def test_ties_by_rank(spark):
    tied = [("q", "b", 0.5), ("q", "a", 0.5), ("q", "c", 0.5)]
    assert _list(_entries(spark, tied, [("q", "z")], n=2)) == [("z", -1.0), ("b", 0.5), ("a", 0.5)]


def test_l2_keeps_the_nearest(spark):
    near = [("q", "a", 0.0), ("q", "b", 0.1), ("q", "c", 0.2), ("q", "d", 0.3)]
    entries = _entries(spark, near, [("q", "a")], n=2, metric="l2")
    assert _list(entries) == [("a", 0.0), ("b", 0.1), ("c", 0.2)]
    # Distance 0 is a hit: the row stays, though its score is not above 0.
    assert formats.valid_results(entries, "l2").count() == 1
    assert formats.valid_results(entries, "cosine").count() == 0
    assert _list(_entries(spark, near, [("q", "a")], n=2, metric="l2", l2_parity=True)) == [("a", 0.0), ("d", 0.3), ("c", 0.2)]


def test_unknown_ids_of_two_languages(spark):
    asked = queries(spark, ["q"], "x").unionByName(queries(spark, ["q"], "y"))
    found = hits(spark, FOUND, "x").unionByName(hits(spark, [("q", "a", 0.1)], "y"))
    entries = mine.mined_entries(asked, found, qrels(spark, [("q", "a")], "x"), 10)
    assert as_set(entries, "lang") == {("x",)}


def test_kd_tables(spark):
    entries = _entries(spark, FOUND, [("q", "z"), ("q", "a")], asked=("q", "r"), n=1)
    row = formats.kd_scores(entries).first()
    assert (row["document_ids"], row["scores"], row["split"]) == (["a", "z", "b"], [0.9, -1.0, 0.8], "x")
    # The dangling positive z stays in the list and is absent from the documents.
    assert as_set(formats.kd_documents(corpus(spark, DOCS), entries), "document_id") == {("a",), ("b",)}
    assert as_set(formats.kd_queries(queries(spark, ["q", "r"]), entries), "query_id") == {("q",)}
    assert as_set(formats.entries_of(formats.kd_scores(entries)), "document_id", "place", "score") == as_set(
        entries, "document_id", "place", "score"
    )


def _long(spark, entries, n=3, **options):
    rows = formats.contrastive_long(entries, corpus(spark, DOCS), n, **options)
    return [(r["ordinal"], r["document_id"]) for r in rows.orderBy("query_id", "ordinal").collect()]


def test_contrastive_numbers_from_zero(spark):
    entries = _entries(spark, FOUND, [("q", "b")])
    assert _long(spark, entries, 2) == [(-1, "b"), (0, "a"), (1, "c")]


def test_extra_positives(spark):
    # z and y are judged and absent from the corpus, g is judged and not retrieved.
    entries = _entries(spark, FOUND, [("q", x) for x in "bcgyz"])
    assert _long(spark, entries, 4) == [(-1, "b"), (0, "c"), (1, "g"), (2, "a"), (3, "d")]
    assert _long(spark, entries, 4, extra_positives="drop") == [(-1, "b"), (0, "a"), (1, "d")]
    with pytest.raises(ValueError):
        formats.contrastive_long(entries, corpus(spark, DOCS), 3, extra_positives="other")


def test_contrastive_validity(spark):
    assert _long(spark, _entries(spark, FOUND, [("q", "z")])) == []  # positive not retrieved
    assert _long(spark, _entries(spark, FOUND[:1], [("q", "a")])) == []  # no negative left
    negative = [("q", "a", -0.2), ("q", "b", -0.3)]
    assert _long(spark, _entries(spark, negative, [("q", "a")])) == []  # not similar at all


def test_hot_documents_take_the_other_path(spark):
    found = [(f"q{i}", d, s) for i in range(12) for d, s in (("a", 0.9), ("b", 0.8), ("c" if i % 2 else "d", 0.5))]
    entries = _entries(spark, found, [(f"q{i}", "a") for i in range(12)], asked=[f"q{i}" for i in range(12)])
    assert _long(spark, entries, 3, hot_rows=4) == _long(spark, entries, 3)


def _wide(spark, entries, n):
    long = formats.contrastive_long(entries, corpus(spark, DOCS), n)
    return formats.contrastive_wide(long, queries(spark, ["q"]), n)


def test_wide_is_padded(spark):
    row = _wide(spark, _entries(spark, FOUND[:2], [("q", "a")]), 3).first()
    assert (row["query"], row["positive"], row["positive_score"]) == ("text of q", "text a", 0.9)
    assert [row[f"negative_{i}"] for i in range(3)] == ["text b", "", ""]
    assert [row[f"negative_{i}_score"] for i in range(3)] == [0.8, 0.0, 0.0]


def test_wide_without_negatives_or_rows(spark):
    entries = _entries(spark, FOUND, [("q", "a")])
    none = _wide(spark, entries, 0)
    assert none.count() == 1 and "negative_0" not in none.columns
    empty = _wide(spark, _entries(spark, FOUND, [("q", "z")]), 2)
    assert empty.count() == 0 and "negative_1_score" in empty.columns


def test_contrastive_limit(spark):
    found = [(f"q{i}", d, s) for i in range(20) for d, s in (("a", 0.9), ("b", 0.8))]
    entries = _entries(spark, found, [(f"q{i}", "a") for i in range(20)], asked=[f"q{i}" for i in range(20)])
    for limit, want in ((0, 20), (None, 20), (5, 5), (50, 20)):
        rows = formats.contrastive_long(entries, corpus(spark, DOCS), 3, limit=limit)
        assert rows.select("query_id").distinct().count() == want


def test_threshold(spark):
    entries = _entries(spark, FOUND, [("q", "b")])
    long = formats.contrastive_long(entries, corpus(spark, DOCS), 5)
    assert as_set(formats.threshold(long, 0.9), "document_id") == {("b",), ("c",), ("d",)}


def test_result_rules(spark, sf):
    """KD ids come from judgements and hits, negatives fall and are never judged."""
    from checks.mining_queries import TEXT_NEGATIVES, text_entries, text_hits
    from checks.tables import beir

    bundle, found = beir(spark, sf), text_hits(spark, sf)
    entries = text_entries(spark, sf)
    judged, retrieved = as_set(bundle.qrels, "query_id", "document_id"), as_set(found, "query_id", "document_id")
    per_query = {}
    for r in entries.orderBy("query_id", "place").collect():
        pair = (r["query_id"], r["document_id"])
        assert pair in judged | retrieved and (pair in judged) == r["is_pos"]
        if not r["is_pos"]:
            per_query.setdefault(r["query_id"], []).append(r["score"])
    assert all(len(s) <= TEXT_NEGATIVES and s == sorted(s, reverse=True) for s in per_query.values())
    again = mine.mined_entries(bundle.queries.repartition(7), found.repartition(5), bundle.qrels.repartition(3), TEXT_NEGATIVES)
    assert as_set(again, "query_id", "place", "document_id", "score") == as_set(entries, "query_id", "place", "document_id", "score")


def test_a_hot_query_is_many_ranges(spark):
    """Ranked by ranges as in one window, and no range holds more than twice the mean."""
    from negsift.operators import mine
    from negsift.operators.order import numbered
    from pyspark.sql import functions as F

    judged = [("hot", f"d{i:05}") for i in range(6000)] + [(f"q{i}", f"d{i:05}") for i in range(50)]
    found = [("hot", f"d{i * 7:05}", 1.0 - i / 100) for i in range(40)] + [(f"q{i}", f"d{j:05}", 0.5 - j / 1000) for i in range(50) for j in range(20)]
    asked, h, r = queries(spark, ["hot", *[f"q{i}" for i in range(50)]]), hits(spark, found), qrels(spark, judged)
    columns = ["query_id", "document_id", "place", "score", "is_pos", "retrieved", "positives"]
    whole = as_set(mine.mined_entries(asked, h, r, 5), *columns)
    assert as_set(mine.mined_entries(asked, h, r, 5, hot_rows=100), *columns) == whole
    assert as_set(mine.mined_entries(asked, h, r, 5, hot_rows=1), *columns) == whole
    part = F.spark_partition_id().alias("part")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as the few rows of this test would be one range
    try:
        sizes = [x["count"] for x in r.orderBy("query_id", "document_id").select(part).groupBy("part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 6 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    places = numbered(r.repartition(9), [F.col("query_id"), F.col("document_id")], "n").orderBy("n").collect()
    assert [x["n"] for x in places] == list(range(6050)) and [x["document_id"] for x in places[:6000]] == [f"d{i:05}" for i in range(6000)]
