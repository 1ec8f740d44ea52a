"""Token vectors of texts: made once, a run of texts at a time."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from negsift.functions import vectors
from negsift.operators.encode import hashed_token_encoder
from tests.rows import corpus


def by_hand(text, limit=None):
    out = []
    for word in [w for w in dict.fromkeys((text or "").lower().split()) if w][:limit]:
        v = np.frombuffer(hashlib.md5(word.encode()).digest(), np.uint8) - 127.5
        out.append((v / np.linalg.norm(v)).astype(np.float32).tolist())
    return out


def test_vectors_leave_in_runs():
    """Texts of one Arrow batch, one of them long, and rows without words: what is held at once is bounded by the texts of a run."""
    texts = [f"a b{i} A" for i in range(3_000)] + ["x y " * 300_000, None, "", " \t"]
    found = list(vectors.token_runs(pa.array(texts)))
    assert max(map(len, found)) <= vectors.RUN_TEXTS and len(found) >= 3
    assert pa.concat_arrays(found).to_pylist() == [by_hand(text) for text in texts]


def test_limit_holds_in_every_run():
    texts = [f"a b{i} c A d" for i in range(vectors.RUN_TEXTS + 5)]
    assert pa.concat_arrays(list(vectors.token_runs(pa.array(texts), 2))).to_pylist() == [by_hand(text, 2) for text in texts]


def test_filter_reads_the_tokens_that_are_there(spark):
    """A filter on tokens does not encode the texts once more below the shuffle."""
    rows = hashed_token_encoder()(corpus(spark, {"a": "one two One", "b": "", "c": None}), "document").filter(F.size("tokens") > 0)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1
    assert [(r["document_id"], r["tokens"]) for r in rows.collect()] == [("a", by_hand("one two"))]
