"""Packed rows carry their ids, and digests are those of the ids as placed."""

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as C
from negsift.llm import packing as P
from negsift.llm.catalog import QUERIES, table
from negsift.llm.tokens import encoder


def test_the_pipeline_ends_in_ids(spark, sf):
    docs = table(spark, sf, "documents").limit(50)
    texts, found = {r["doc_id"]: r["text"] for r in docs.collect()}, {}
    for r in C.pack(spark, docs, sf).collect():
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        found.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
    whole = {d: [i for _, ids in sorted(p) for i in ids] for d, p in found.items()}
    assert whole == {d: [*encoder().ids(t or "").tolist(), P.END] for d, t in texts.items()}


def test_the_digest_sees_what_was_placed(spark, sf, monkeypatch):
    import negsift.llm.queries  # noqa: F401

    digests = lambda: sorted(r["ids_crc32"] for r in QUERIES["op10_best_fit"](spark, sf).collect())
    right, own = digests(), P.pieces
    monkeypatch.setattr(P, "pieces", lambda *a, **b: own(*a, **b).withColumn("ids", F.transform("ids", lambda i: i + 1)))
    assert digests() != right
