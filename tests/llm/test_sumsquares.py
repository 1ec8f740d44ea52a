"""Sum-of-squares packing: the rule by definition, whole texts back, no padding."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from negsift.llm import sumsquares as S
from negsift.llm.catalog import table
from negsift.llm.tokens import encoder


def by_definition(lengths, size):
    """The level each length goes to, by the sum of squares of all counts after each choice."""
    counts, out = [0] * size, []
    for length in lengths:
        best = None
        for level in range(size - length, -1, -1):
            if level and not counts[level]:
                continue
            after = counts[:]
            if level:
                after[level] -= 1
            if level + length < size:
                after[level + length] += 1
            total = sum(n * n for n in after)
            if best is None or total < best[0]:
                best = total, level, after
        out.append(best[1])
        counts = best[2]
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 24).flatmap(lambda size: st.tuples(st.just(size), st.lists(st.integers(1, size), max_size=80))))
def test_levels(case):
    size, lengths = case
    levels, got = S.Levels(size), []
    for length in lengths:
        level = levels.level_for(length)
        got.append(level)
        if level:
            levels.take(level)
        if level + length < size:
            levels.put(level + length, None)
    assert got == by_definition(lengths, size)


def check(docs, rows, size, ids_of, end):
    """Rows hold every document whole and once, sequences have no gap and no padding."""
    pieces, sequences, want = defaultdict(list), defaultdict(list), Counter()
    for doc, text in docs:
        want[(doc, tuple([*ids_of(text or ""), end]))] += 1
    for r in rows:
        assert len(r["ids"]) == r["length"] > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["doc_tokens"], tuple(r["ids"])))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at == size or at & (at - 1) == 0 and at < size
    ids_only_once = {k[0]: k[1] for k in want if sum(n for (d, _), n in want.items() if d == k[0]) == 1}
    for doc, ids in ids_only_once.items():
        own = sorted(pieces[doc])
        assert tuple(t for _, _, part in own for t in part) == ids and {n for _, n, _ in own} == {len(ids)}
        assert [s for s, _, _ in own] == [sum(len(p) for _, _, p in own[:i]) for i in range(len(own))]
    assert Counter(t for p in pieces.values() for _, _, part in p for t in part) == Counter(t for (_, ids), n in want.items() for t in ids * n)
    return len(sequences)


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    exact = encoder().exact
    rows = S.pack(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(texts, rows, 2048, lambda t: exact.encode(t, add_special_tokens=False).ids, 1)


def test_few_documents_are_cut(spark, sf):
    """Documents that fit a window are cut only where open windows are settled."""
    docs = table(spark, os.path.join(os.path.dirname(sf), "sf0.1"), "documents").coalesce(1)
    rows = S.pack(docs).filter("start > 0 and doc_tokens <= 2048")
    assert rows.count() <= 0.05 * docs.count()


def test_settled_windows():
    """Nothing is lost where few tokens may be open, and open windows stay within bounds."""
    rng = random.Random(3)
    packer = S.Packer(64, 500)
    lengths = [rng.choice([1, 33, 40, 63, 64, 65, 200]) for _ in range(3000)]
    for i, n in enumerate(lengths):
        packer.add(i, np.arange(n, dtype="<u4"))
        assert packer.open_tokens < 500 == packer.max_open
        assert packer.open_tokens == sum(level * len(w) for level, w in enumerate(packer.levels.windows))
    packer.settle()
    got = defaultdict(list)
    for sequence in packer.done:
        total = sum(len(ids) for _, _, ids in sequence)
        assert total == 64 or total & (total - 1) == 0
        for i, start, ids in sequence:
            got[i].append((start, ids.tolist()))
    for i, n in enumerate(lengths):
        assert [t for _, part in sorted(got[i]) for t in part] == list(range(n))


def test_rule_fills_windows():
    """Lengths that add up to whole windows leave few of them open."""
    rng = random.Random(1)
    packer = S.Packer(100, 1 << 30)
    for i in range(20_000):
        packer.add(i, np.zeros(rng.randint(1, 50), "<u4"))
    assert len(packer.done) > 4900 and sum(map(len, packer.levels.windows)) < 150


def test_odd_rows(spark, odd, nothing):
    exact = encoder().exact
    for frame in (odd, odd.repartition(5), odd.limit(0)):
        rows = S.pack(frame, size=256).collect()
        check([(r["doc_id"], r["text"]) for r in frame.collect()], rows, 256, lambda t: exact.encode(t, add_special_tokens=False).ids, 1)
    assert S.pack(nothing).collect() == []
