"""WARC: archives that read back to the pages, one response per payload."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from negsift.llm import warc as A

PAGES = [
    (5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, None, "same"), (1, "http://a/1", ""), (2, "http://a/2", None),
    (4, "bad\r\nWARC-Type: revisit", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (6, "http://a/6", "é漢" * 10),
    (7, "http://a/7", "twice"), (7, "http://a/7", "twice"), (None, "http://a/n", "same"), (8, "http://a/8", "\r\n\r\n"), (10, "", "long " * 50_000),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def brute(pages, least):
    first = {}
    for i, (page, _, payload) in sorted(enumerate(pages), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        first.setdefault(payload or "", i)
    out = []
    for i, (page, _, payload) in enumerate(pages):
        raw = (payload or "").encode()
        own = first[payload or ""] == i or len(raw) < least
        out.append((page, len(raw), digest(payload), "response" if own else "revisit", None if own else pages[first[payload or ""]][0]))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1).withColumns({c: F.lit(1) for c in ("row", "bytes", "payload", "sha1")})


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(pages, least):
    rows = A.round_trip(pages, least).collect()
    assert all(r["matches"] for r in rows)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str) == brute(PAGES, least)


def test_archives(spark, pages, tmp_path):
    path = f"file://{tmp_path}/warc"
    A.write_archives(pages, path, file_bytes=2000)
    rows = A.read_archives(spark, path).collect()
    assert len({r["record_id"] for r in rows}) == len(rows) == len(PAGES)
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in rows if r["record_type"] == "response"}
    assert all(payloads[p] == (t or "") for p, _, t in PAGES if p in payloads)
    assert all(r["payload"] == b"" for r in rows if r["record_type"] == "revisit")
    assert len(list((tmp_path / "warc").glob("part-*.gz"))) > 1


def test_a_missing_response_is_seen(spark, pages):
    path = A.scratch_path(spark, "warc")
    A.write_archives(pages, path)
    read = A.read_archives(spark, path, keep_payload=False)
    lost = A.resolved(read.filter("not (record_type = 'response' and page_id = 3)"))
    assert [r["refers_to"] for r in lost.filter("page_id = 5").collect()] == [None]


def test_bitmaps_in_parts(spark, pages):
    """With room for one bitmap at a time, the responses are those that need no bitmap at all."""
    rows = A.headers(spark.range(100_000, numPartitions=4).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), (F.col("id") % 70_000).cast("string").alias("html")), "page_id", "url", "html")
    again = A.stored(A.revisits(rows, 0), "revisits")
    want = rows.join(again, "row", "left_anti").select("page_id").orderBy("page_id").collect()
    assert len(want) == 70_000
    for room in (4096, 3 * 4096, 1 << 20):
        assert A.responses(rows, again, room).select("page_id").orderBy("page_id").collect() == want


def test_payloads_are_not_shuffled(spark, pages):
    rows = A.headers(pages, "page_id", "url", "html")
    plan = A.records(rows, A.stored(A.revisits(rows, 0), "revisits"))._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line and "payload" in line]
    assert "SortMergeJoin" not in plan


def test_dates(spark, pages, tmp_path):
    import gzip

    for name, date in (("given", "2020-02-03T04:05:06Z"), ("now", None)):
        A.write_archives(pages, f"file://{tmp_path}/{name}", date=date)
        heads = [h for f in (tmp_path / name).glob("part-*") for h, _ in A.parse(gzip.decompress(f.read_bytes()))]
        found = {h["warc-date"] for h in heads}
        assert found == {date} if date else len(found) == 1 and min(found) > "2024"


def test_empty(spark):
    assert A.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
