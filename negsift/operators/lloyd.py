"""Centroids and codes of all bundles together, one pass over the corpus per turn.

Seeds are drawn on the driver from a bounded sample of each bundle, far ones more often (k-means++). A turn then
assigns every vector of every bundle to its nearest centroid and adds up what each of them got:
tasks add up their own first, so that what is shuffled is a row per task and centroid, and what comes to the driver
is a row per centroid. The number of Spark jobs depends on the turns alone, not on the number of
languages, cells or sub-vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window as W, functions as F

from negsift.operators.scorers import inner_or_distance, matrix
from negsift.schema import KEYS

Matrices = dict[tuple[str, str], np.ndarray]

TURNS = 10
SAMPLE = 32  # rows of the sample for each centroid
_ROWS = 4096  # vectors compared with all centroids at once


def some_rows(rows: DataFrame, most: int, seed: int) -> Matrices:
    """Up to ``most`` vectors of each bundle, by a hash of their row number: a vector that is frequent is so in the sample."""
    order = W.partitionBy(*KEYS).orderBy(F.xxhash64(F.lit(seed), "_row"))
    rows = rows.select(*KEYS, "embedding", F.monotonically_increasing_id().alias("_row"))
    first = rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= most)
    by: dict[tuple, list] = {}
    for r in first.select(*KEYS, "embedding", "_place").orderBy(*KEYS, "_place").toLocalIterator():
        by.setdefault((r["dataset"], r["lang"]), []).append(r["embedding"])
    return {key: np.array(vectors, float) for key, vectors in by.items()}


def far_seeds(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` rows of the sample, each drawn with the square of its distance to those before."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(sample)))]
    apart = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(k, len(sample)):
        total = apart.sum()
        nxt = int(rng.choice(len(sample), p=apart / total)) if total > 0 else int(np.setdiff1d(np.arange(len(sample)), chosen)[0])
        chosen.append(nxt)
        apart = np.minimum(apart, ((sample - sample[nxt]) ** 2).sum(1))
    return sample[chosen].copy()


def summed(rows: DataFrame, add: Callable) -> dict[tuple, dict[int, np.ndarray]]:
    """Per bundle and table number, matrices added up over all rows.

    ``add(bundle, block, held)`` adds a block of vectors to ``held``, a dictionary of matrices by table
    number, which starts empty in each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple, dict[int, np.ndarray]] = {}
        for batch in batches:
            bundles = pa.table({"a": batch.column(0), "b": batch.column(1)}).to_pandas().groupby(["a", "b"]).indices
            for key, at in bundles.items():
                block = matrix(pa.chunked_array([batch.column(2).take(pa.array(at))]))
                for lo in range(0, len(block), _ROWS):
                    add(key, block[lo : lo + _ROWS], own.setdefault(key, {}))
        for (dataset, lang), held in own.items():
            for number, table in held.items():
                many = len(table)
                columns = [pa.array([dataset] * many), pa.array([lang] * many), pa.array(np.full(many, number, np.int32))]
                columns += [pa.array(np.arange(many, dtype=np.int32)), pa.array(list(table), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*KEYS, "number", "i", "v"])

    parts = rows.select(*KEYS, "embedding").mapInArrow(run, "dataset string, lang string, number int, i int, v array<double>")
    total = parts.groupBy(*KEYS, "number", "i").agg(Summarizer.sum(array_to_vector("v")).alias("v")).orderBy(*KEYS, "number", "i")
    out: dict[tuple, dict] = {}
    for r in total.toLocalIterator():
        out.setdefault((r["dataset"], r["lang"]), {}).setdefault(r["number"], []).append(r["v"].toArray())
    return {key: {number: np.array(lines) for number, lines in of.items()} for key, of in out.items()}


def add_to(held: dict[int, np.ndarray], number: int, block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Add each vector, and a one, to the row of its nearest centroid; returns which that is."""
    nearest = inner_or_distance(block, centroids, "l2").argmin(1)
    table = held.setdefault(number, np.zeros((len(centroids), block.shape[1] + 1)))
    np.add.at(table, nearest, np.hstack([block, np.ones((len(block), 1))]))
    return nearest


def moved(centroids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Each centroid at the mean of what it got; one that got nothing stays."""
    out, some = centroids.copy(), table[:, -1] > 0
    out[some] = table[some, :-1] / table[some, -1:]
    return out


def lloyd(rows: DataFrame, seeds: Matrices, turns: int = TURNS) -> Matrices:
    """Centroids of all bundles after some turns."""
    now = {key: block.copy() for key, block in seeds.items()}
    for _ in range(turns):
        shared = rows.sparkSession.sparkContext.broadcast(now)

        def add(key, block, held, shared=shared):
            if key in shared.value:
                add_to(held, 0, block, shared.value[key])

        found = summed(rows, add)
        after = {key: moved(block, found[key][0]) if key in found else block for key, block in now.items()}
        still = all(np.allclose(after[key], now[key], rtol=0, atol=1e-9) for key in now)
        now = after
        if still:
            break
    return now
