"""Attribution against each token and section taken alone."""

import numpy as np
import pytest

from negsift.llm import attribution as A
from negsift.llm.tokens import default_paths, encoder


def brute(starts, ends, tokens, rule):
    out = np.zeros(len(starts) + 1)
    for a, b in tokens:
        shared = [max(0, min(e, b) - max(s, a)) for s, e in zip(starts, ends)]
        if not any(shared):
            out[-1] += 1
        elif rule == "first":
            out[next(i for i, n in enumerate(shared) if n)] += 1
        elif rule == "most":
            out[shared.index(max(shared))] += 1
        else:
            out[:-1] += np.array(shared) / sum(shared)
    return out


@pytest.mark.parametrize("rule", A.RULES)
def test_rules(rule):
    rng = np.random.default_rng(8)
    for _ in range(200):
        cuts = np.sort(rng.integers(0, 40, 2 * rng.integers(1, 7)))
        starts, ends = cuts[::2], cuts[1::2]
        edges = np.unique(np.append(rng.integers(0, 44, 12), [0, 44]))
        first, last = edges[:-1], edges[1:]
        got = A.allocate(starts, ends, first, last, rule)
        assert np.allclose(got, brute(starts, ends, list(zip(first, last)), rule))


@pytest.mark.parametrize("rule", A.RULES)
def test_documents(odd, rule):
    docs = odd.filter("doc_id is null or doc_id <> 6")
    rows = A.attribute(docs, ["source", "lang", "text"], by_line={"text"}, rule=rule).collect()
    coder = encoder(default_paths(), False)
    want = []
    for r in docs.collect():
        text, names, starts, ends = A.sections_of([(n, r[n] or "") for n in ("source", "lang", "text")], {"text"})
        found = coder.exact.encode(text, add_special_tokens=False)
        counts = brute(starts, ends, found.offsets, rule)
        places = [*zip(range(len(names)), names, starts, ends), (-1, None, 0, len(text))]
        assert all(text[a:b] in (r[n] or "") for _, n, a, b in places[:-1])
        want += [(r["doc_id"], i, n, int(a), int(b), round(c, 6), len(found.ids)) for (i, n, a, b), c in zip(places, counts)]
    assert sorted(((*r[:5], round(r[5], 6), r[6]) for r in rows), key=str) == sorted(want, key=str)


def test_sections_add_up(odd, nothing):
    rows = A.attribute(odd, ["text", "source"]).collect()
    assert sum(r["tokens"] for r in rows) == sum(r["document_tokens"] for r in rows if r["section"] == -1)
    assert A.attribute(nothing, ["text"]).collect() == []
    with pytest.raises(ValueError):
        A.attribute(odd, ["text"], rule="other")
