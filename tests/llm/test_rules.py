"""Rules: measures by plain Python, one verdict in any order."""

import re
from collections import Counter

from pyspark.sql import functions as F

from negsift.llm import rules as R
from negsift.llm.catalog import table


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_capitals": len(re.findall("[A-Z]", text)), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def rejected(m):
    return (
        m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
        or 10 * m["n_dup_lines"] > 3 * m["n_lines"] or not 2 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"]
        or 2 * m["n_capitals"] > m["word_chars"]
    )


def test_measures(odd):
    text = F.col("text")
    one_by_one = odd.select("text", *[v.alias(k) for k, v in R.measures(text).items()]).collect()
    at_once = R.with_measures(odd.select("doc_id", text, text.alias("copy"))).collect()
    for r, s in zip(one_by_one, at_once):
        want = plain(r["text"])
        assert {k: r[k] for k in want} == want
        assert {k: s[k] for k in want} == plain(s["copy"])


def test_verdict_in_any_order(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    want = {r["doc_id"] for r in docs.collect() if not rejected(plain(r["text"]))}
    for order in (R.RULES, R.RULES[::-1]):
        rows = R.cascade(docs, order, sample_rows=100).collect()
        assert {r["doc_id"] for r in rows if r["rejected_by"] is None} == want
        for r in rows:
            if r["rejected_by"]:
                rule = next(x for x in R.RULES if x.name == r["rejected_by"])
                assert rule.rejects(plain(r["text"])) in (True, 1) or rule.name == "word_length"
    assert {r["doc_id"] for r in R.keep_good(docs).collect()} == want


def test_order_is_by_rejections_per_cost(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("w"), 200)).alias("text"))
    never, always = R.Rule("never", lambda m: m["n_words"] < 0), R.Rule("always", lambda m: m["n_words"] >= 0)
    late = R.Rule("also", lambda m: m["n_repeat_words"] > 0)
    assert {r[0] for r in R.cascade(docs, [never, late, always]).select("rejected_by").distinct().collect()} <= {"always", "also"}
    assert [e[2] for e in R.estimates(docs, [never, always], R.measures(F.col("text")))] == [0.0, 1.0]


def test_odd_rows(odd, nothing):
    rows = R.cascade(odd).collect()
    assert len(rows) == odd.count()
    assert all((r["rejected_by"] is not None) == bool(rejected(plain(r["text"]))) for r in rows)
    assert R.keep_good(odd).columns == odd.columns
    assert R.cascade(nothing).collect() == []


def test_clean_documents_stay(spark, sf):
    labels = table(spark, sf, "labels").filter("quality = 1 and toxic = 0")
    clean = table(spark, sf, "documents").join(labels, "doc_id").filter(F.size(F.split("text", r"\s+")) >= 50)
    assert R.keep_good(clean).count() >= 0.98 * clean.count()


def test_clashing_columns(spark):
    rows = spark.createDataFrame([("a b", "x", "y", "z")], "text string, n_words string, _words string, _lines string")
    found = R.with_measures(rows)
    assert found.columns.count("n_words") == 1 and found.first()["n_words"] == 2 and found.first()["_words"] == "y"


def test_ready_rules_come_first_when_others_reject_no_more(spark):
    """Comparisons of ready numbers cost the least measurable time, whatever the clock says, so the same order comes out."""
    texts = spark.range(400).select(F.concat_ws(" ", F.array_repeat(F.lit("AB"), 4000)).alias("text"))
    docs = R.with_measures(texts, names=["n_words"])
    ready = R.Rule("ready", lambda m: m["n_words"] > 0)
    slow = R.Rule("slow", lambda m: m["n_repeat_words"] > 0)
    for rules in ([ready, slow], [slow, ready]):
        judged = R.cascade(docs, rules, found={"n_words": F.col("n_words")}, sample=R.sample_of(docs, 200))
        assert [r[0] for r in judged.select("rejected_by").distinct().collect()] == ["ready"]


def test_sample_is_of_all_rows(spark):
    docs = spark.range(20_000).select(F.col("id").cast("string").alias("text"))
    ids = [int(r[0]) for r in R.sample_of(docs, 1000).collect()]
    assert 800 < len(ids) < 1200 and max(ids) > 19_000
    assert R.sample_of(docs, 50_000).count() == 20_000
