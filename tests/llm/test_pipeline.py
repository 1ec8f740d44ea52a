"""The pipeline: each stage against its own brute-force version, on what it was given."""

from collections import Counter

import corpus_pipeline as C
from negsift.llm import mixing as M
from negsift.llm.catalog import table
from negsift.llm.tokens import encoder
from negsift.session import stored
from test_packing import check, piece_by_piece
from test_rules import plain, rejected
from test_simhash import brute


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    (_, quality), (_, dedup), (_, mix), (_, pack) = C.STAGES

    good = stored(quality(spark, docs, sf), "t")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {r["doc_id"]: r for r in good.collect()}
    assert kept == {i: r for i, r in rows.items() if not rejected(plain(r["text"]))}

    one = stored(dedup(spark, good, sf), "t")
    groups = brute([(i, r["text"]) for i, r in kept.items()], 3)
    left = {r["doc_id"]: r for r in one.collect()}
    assert left == {i: kept[i] for i, _, group in groups if i == group}
    assert len(left) < len(kept)

    mixed = stored(mix(spark, one, sf), "t")
    many = Counter(r["doc_id"] for r in mixed.collect())
    labels = M.labelled(table(spark, sf, "labels"), ["toxic"])
    found = M.mixed(one, labels, M.TOXIC_TARGETS, ["toxic"]).collect()
    tokens = sum(r["tokens"] for r in found)
    for i, share in enumerate(M.TOXIC_TARGETS):
        assert abs(sum(r["tokens"] * r["rate"] * r["p"][i] for r in found) / tokens - share) < 1e-3
    assert all(many[r["doc_id"]] in (int(r["rate"]), int(r["rate"]) + 1) for r in found)
    assert all(r == left[r["doc_id"]] for r in mixed.collect())

    packed = pack(spark, mixed, sf).collect()
    exact = encoder().exact
    texts = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    opened = check(texts, packed, 1024, lambda t: exact.encode(t, add_special_tokens=False).ids)
    assert opened == len(piece_by_piece([r["length"] for r in packed], 1024))
    assert good.columns == one.columns == mixed.columns == columns


def test_run(spark, sf):
    rows = C.run(spark, sf)
    assert rows.count() > 0 and "sequence_id" in rows.columns


def test_odd_rows(spark, odd, nothing, sf):
    for docs in (odd.drop("word"), nothing):
        for _, stage in C.STAGES[:-1]:
            docs = stored(stage(spark, docs, sf), "t")
        C.STAGES[-1][1](spark, docs, sf).collect()
