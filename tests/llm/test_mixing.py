"""Mixing: totals meet the targets, and rates are those of the same steps in plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from negsift.llm import mixing as M
from negsift.llm.catalog import table

SHARES = [M.TARGETS[d] for d in M.DOMAINS]


def moments(spark, seed=0, rows=400):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.3] * 4, rows).round(6)
    data = [(int(rng.integers(1, 500)), int(rng.integers(1, 3)), [float(x) for x in q]) for q in p]
    return data, spark.createDataFrame(data, "tokens long, rows long, p array<double>")


@pytest.mark.parametrize("shares", [SHARES, [0.25] * 4, [0.7, 0.1, 0.1, 0.1], [1.0, 0.0, 0.0, 0.0]])
def test_totals_meet_the_targets(spark, shares):
    data, rows = moments(spark)
    way = M.fit(rows, shares)
    n, p = np.array([a * b for a, b, _ in data], float), np.array([q for _, _, q in data])
    rates = np.maximum(0, 1 - p @ np.array(way))
    got = np.array([r[0] for r in rows.select(M.rate(F.col("p"), way)).collect()])
    assert np.allclose(got, rates) and (got >= 0).all()
    off = np.abs((n * rates) @ p / n.sum() - shares).max()
    if min(shares) > 0:
        assert off <= 2e-4
    else:  # out of reach: no document is of one domain alone
        assert off < 0.02
        # No rate can go up or down and bring the totals nearer, but for the pull towards 1.
        gap = (n * rates) @ p / n.sum() - shares
        slope = p @ gap + M.RIDGE * (rates - 1)
        assert np.abs(slope[rates > 0]).max() < 1e-4 and slope[rates == 0].min() > -1e-4


def test_classifier_on_held_out_labels(spark, sf):
    docs, labels = table(spark, sf, "documents"), M.labelled(table(spark, sf, "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    weights = M.classifier(docs, labels.filter(~fold))
    rows = M.posteriors(docs, weights).join(labels.filter(fold), "doc_id").collect()
    assert len(rows) > 30
    assert np.mean([abs(sum(r["p"]) - 1) for r in rows]) < 1e-5
    quality = np.mean([(r["p"][2] + r["p"][3] > 0.5) == (r["quality"] == 1) for r in rows])
    toxic = np.mean([(r["p"][1] + r["p"][3] > 0.5) == (r["toxic"] == 1) for r in rows])
    assert quality > 0.85 and toxic > 0.9


def test_posteriors_by_definition(spark, odd):
    """A document's log odds are the weights of its features, added up."""
    weights = [{"feature": M._BIAS, "w": [0.25, -1.0]}, {"feature": "word3", "w": [1.0, 0.5]}, {"feature": M._ENDING + "1", "w": [-2.0, 0.0]}, {"feature": "a", "w": [0.5, 4.0]}]
    by = {w["feature"]: np.array(w["w"]) for w in weights}
    rows = M.posteriors(odd, weights).collect()
    texts = {}
    for r in odd.collect():
        texts.setdefault((r["doc_id"], r["text"] or ""), 0)
        texts[(r["doc_id"], r["text"] or "")] += 1
    want = []
    for (doc, text), many in texts.items():
        words = [w for w in text.lower().replace("\t", " ").replace("\n", " ").split(" ") if w]
        found = {M._BIAS, *words, *(M._ENDING + w[-1] for w in words)}
        one = 1 / (1 + np.exp(-sum(by[f] for f in found if f in by)))
        want.append((doc, len(words), many, *np.round([(1 - one[0]) * (1 - one[1]), (1 - one[0]) * one[1], one[0] * (1 - one[1]), one[0] * one[1]], 4)))
    got = [(r["doc_id"], r["tokens"], r["rows"], *np.round(r["p"], 4)) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_resampled(spark, sf):
    docs, labels = table(spark, sf, "documents"), M.labelled(table(spark, sf, "labels"))
    found = M.mixed(docs, labels, SHARES).withColumn("copies", M.copies(F.col("rate"), F.col("key"))).cache()
    out = M.resample(docs, labels, SHARES)
    assert out.columns == docs.columns
    many = {r[0]: r[1] for r in out.groupBy("doc_id").count().collect()}
    want = found.collect()
    assert many == {r["doc_id"]: r["copies"] for r in want if r["copies"]}
    assert all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in want)
    assert abs(sum(r["copies"] for r in want) - sum(r["rate"] for r in want)) < 3 * len(want) ** 0.5


def test_odd_rows(spark, odd, nothing):
    labels = M.labelled(spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (6, 0, 1), (8, 1, 1), (None, 1, 1), (7, 5, 0)], "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in labels.collect()) == [(1, 0, 0), (6, 0, 1), (8, 1, 1)]
    rows = M.mixed(odd, labels, SHARES).collect()
    assert sum(r["rows"] for r in rows) == odd.count() and all(r["rate"] >= 0 for r in rows)
    assert {r["tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert M.resample(odd, labels, SHARES).columns == odd.columns
    assert M.mixed(nothing, labels, SHARES).collect() == []


def test_without_labels(spark, odd):
    none = M.labelled(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = M.mixed(odd, none, [0.25] * 4).collect()
    assert all(r["p"] == [0.25] * 4 and r["rate"] == pytest.approx(1.0) for r in rows)
