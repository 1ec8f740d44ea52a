"""Chat: what is read back is what went in, and the mask holds assistant texts alone."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from negsift.llm import chat as C
from negsift.llm.tokens import default_paths, encoder

TRICKY = ["", "<|im_end|>", "<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|im_start|>", "<", "|x", "\n", "\n\n", " a ", "é漢<|", "\\", "<|<|", "<<|>"]
some = st.one_of(st.sampled_from(TRICKY), st.text(alphabet="<|\\\n aé", max_size=12))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), some), some), max_size=6))
def test_round_trip(turns):
    text, spans = C.render(turns)
    assert [(r, C.unescape(t)) for r, t, _ in C.parse(text)] == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count(C.START) == text.count(C.STOP) == len(turns)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), some), min_size=1, max_size=5))
def test_whole_is_its_turns(turns):
    """No token crosses from one turn into the next, so parts encode like the whole."""
    coder = encoder(default_paths(), False)
    whole = coder.ids(C.render(turns)[0]).tolist()
    assert whole == [i for t in turns for i in coder.ids(C.render([t])[0]).tolist()]


def test_mask_is_every_token_that_meets_a_text():
    coder = encoder(default_paths(), False)
    text, spans = C.render([("user", "hi"), ("assistant", "\n\nwell <|im_end|> é漢"), ("assistant", ""), ("assistant", "x")])
    ids, first, last = coder.spans(text)
    mask, held = C.align(spans, first, last)
    assert mask.tolist() == [any(a < e and b > s for s, e in spans) for a, b in zip(first, last)]
    assert held == [(a, b) for a, b in spans if a < b]


def want(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(role or "", text or "") for c, _, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(C.render(turns)[0]))
    return out


@pytest.mark.parametrize("part", [C.PART, 40])
def test_odd_rows(spark, part):
    rows = [(c, t, r, x) for c in (1, 2) for t, (r, x) in enumerate([("user", "q"), *[("assistant", s) for s in TRICKY]])]
    rows += [(3, 0, None, None), (None, 1, "user", "a"), (None, 0, "assistant", "b"), (4, None, "assistant", "x"), (4, 5, "assistant", "y"), (4, 5, "assistant", "y")]
    rows += [(5, i, "assistant" if i % 2 else "user", f"turn {i} ") for i in range(2000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("part", "ids", "loss_mask")})
    formatted = C.format_conversations(turns, part_chars=part).cache()
    got = {r["conv_id"]: tuple(r)[1:] for r in C.read_back(formatted).collect()}
    assert got == want(rows)
    if part == 40:
        assert formatted.groupBy("conv_id").count().agg(F.max("count")).first()[0] > 100


def test_nothing_outside_the_mask_is_read(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "learn this")], "conv_id long, turn long, role string, text string")
    formatted = C.format_conversations(turns)
    off = formatted.withColumn("loss_mask", F.transform("loss_mask", lambda x: F.lit(False)))
    assert C.read_back(off).first()["loss_chars"] == 0


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.round_trip(empty).collect() == []


class _Frame:
    """Takes the function that a frame would run in its tasks."""

    dtypes = [("conv_id", "bigint")]

    def select(self, *columns):
        return self

    repartition = sortWithinPartitions = select

    def mapInArrow(self, run, schema):
        return run


def test_parts_are_read_one_at_a_time():
    """What a task holds beside its batch is a part, not a hundred of them as Python numbers."""
    import tracemalloc

    import pyarrow as pa

    rows = [(c, "assistant" if i % 2 else "user", "word " * 200) for c in range(30) for i in range(100)]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["conv_id", "role", "text"])
    written = pa.Table.from_batches(C.format_conversations(_Frame())(iter([batch])))
    assert len(written.to_batches()) >= 2
    parts = written.select(["conv_id", "text", "ids", "loss_mask", "loss_starts", "loss_ends"]).combine_chunks().to_batches()
    tracemalloc.start()
    found = [r for out in C.read_back(_Frame())(iter(parts)) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["n_turns"] for r in found] == [100] * 30 and all(r["loss_chars"] == 50 * 1000 for r in found)
    assert peak < 20 << 20
