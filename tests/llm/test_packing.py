"""Packing: whole texts come back, sequences hold, and as many as piece-by-piece best fit."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from negsift.llm import packing as P
from negsift.llm.catalog import table
from negsift.llm.tokens import default_paths, encoder


def piece_by_piece(lengths, size):
    """Remaining capacities of the sequences."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits)[1]] -= length
        else:
            room.append(size - length)
    return sorted(room)


def by_plan(lengths, size):
    segments, opened = P.best_fit_decreasing(Counter(lengths), size)
    held = {}
    for n, (length, first, sequence, offset, each) in enumerate(segments):
        more = segments[n + 1] if n + 1 < len(segments) and segments[n + 1][0] == length else None
        last = more[1] if more else Counter(lengths)[length]
        for k in range(last - first):
            held.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
    assert set(held) == set(range(opened))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return sorted(size - sum(length for _, length in places) for places in held.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=120), st.integers(24, 40))
def test_equals_piece_by_piece(lengths, size):
    assert by_plan(lengths, size) == piece_by_piece(lengths, size)


def test_many_lengths():
    lengths = random.Random(5).choices(range(1, 1025), k=2000)
    assert by_plan(lengths, 1024) == piece_by_piece(lengths, 1024)


def check(docs, rows, size, ids_of):
    """``rows`` hold every document whole, and sequences without gaps."""
    own, sequences = Counter(), {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        own[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
    want = Counter()
    for doc, text in docs:
        ids = np.append(ids_of(text or ""), 2).astype("<u4")
        for n, (start, many) in enumerate(P.cut(len(ids), size)):
            want[(doc, n, start, many, zlib.crc32(ids[start : start + many].tobytes()))] += 1
    assert own == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_documents(spark, sf):
    docs = table(spark, sf, "documents")
    rows = P.pack(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    exact = encoder().exact
    many = check(texts, rows, 1024, lambda t: exact.encode(t, add_special_tokens=False).ids)
    assert many == len(piece_by_piece([r["length"] for r in rows], 1024))
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_odd_rows(odd, nothing):
    rows = P.pack(odd, size=16).collect()
    exact = encoder().exact
    check([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()], rows, 16, lambda t: exact.encode(t, add_special_tokens=False).ids)
    assert P.pack(nothing).collect() == []


@pytest.mark.parametrize("specials", [True, False])
def test_both_encoders_agree(specials):
    coder = encoder(default_paths(), specials)
    texts = ["", " ", "a  b\n\n c\t", "Ünïcödé ça — “x” 12½ ² ª", "don't I'll we've", "漢字 ̀ \x85  x", "<|endoftext|> a", "x" * 500, "\r\n \r\n", "ǅ Ǆ ŉ"]
    for text in texts:
        want = coder.exact.encode(text, add_special_tokens=False)
        ids, first, last = coder.spans(text)
        assert ids.tolist() == want.ids
        assert list(zip(first.tolist(), last.tolist())) == want.offsets


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2100, exclude_categories=["Cs"]), max_size=60))
def test_both_encoders_agree_on_any_text(text):
    coder = encoder(default_paths(), False)
    assert coder.ids(text).tolist() == coder.exact.encode(text, add_special_tokens=False).ids
