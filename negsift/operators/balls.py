"""Exact search that leaves out cells which cannot hold a hit.

A cell is cut into rings by the distance of its documents to the centroid. What is known of a ring, its
smallest and largest distance and its longest vector, bounds the score of every document in it:
a query at distance d of the centroid is at least ``max(d - hi, lo - d, 0)`` away (triangle
inequality), and an inner product is at most that with the centroid plus ``|q| hi``. A query first
searches the ``nprobe`` rings with the best bounds. The k-th score found there is its
floor; then it searches the rings whose bound reaches the floor, and no other.
The result is that of ``flat`` for every metric: no document is left out that could be in it.

Only the rings' bounds and the centroids, whose number is a parameter, come to the driver and to
all tasks. Random vectors have no rings to leave out; clustered ones leave out most.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from negsift.operators.cells import INTS, Matrices, _per_bundle, as_indexed, nearest_cells, prepared, train_cells
from negsift.operators.scorers import Dense, check_metric, inner_or_distance, matrix
from negsift.operators.topk import best, topk
from negsift.schema import KEYS
from negsift.session import stored

#: Bounds are widened by this share of the vectors' lengths, which covers the rounding of scores and sums.
SLACK = 1e-7


class Rings(NamedTuple):
    """Of one bundle: number, cell, and bounds of each ring."""

    ring: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    longest: np.ndarray
    centroids: np.ndarray

    def bounds(self, q: np.ndarray, metric: str) -> np.ndarray:
        """What a document of each ring can score at best, larger being better."""
        lengths = np.linalg.norm(q, axis=1)[:, None]
        apart = np.sqrt(inner_or_distance(q, self.centroids, "l2"))[:, self.cell]
        size = lengths + self.longest[None, :]
        near = np.maximum(np.maximum(apart - self.high, self.low - apart) - SLACK * size, 0.0)
        if metric == "l2":
            return SLACK * size * size - near * near
        along = (q @ self.centroids.T)[:, self.cell] + lengths * self.high
        around = (lengths**2 + self.longest**2 - near * near) / 2
        return np.minimum(along, around) + SLACK * size * size


class Balls(NamedTuple):
    celled: DataFrame  # dataset, lang, document_id, embedding, ring
    rings: dict[tuple[str, str], Rings]


def _distance(rows: DataFrame, centroids: Matrices, metric: str):
    """Distance of each row to the centroid of its cell, and its own length."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def far(dataset: pa.Array, lang: pa.Array, cell: pa.Array, vectors: pa.Array) -> pa.Array:
        block, cells = as_indexed(matrix(pa.chunked_array([vectors])), metric), cell.to_numpy(zero_copy_only=False)
        out = np.zeros((len(block), 2))
        for key, at in pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices.items():
            out[at, 0] = np.linalg.norm(block[at] - shared.value[key][cells[at]], axis=1)
        out[:, 1] = np.linalg.norm(block, axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * 2), pa.array(out.ravel()))

    return far.asNondeterministic()("dataset", "lang", "cell", "embedding")


def build_balls(corpus: DataFrame, nlist: int = 100, metric: str = "cosine", rings: int = 4, seed: int = 42, centroids: Matrices | None = None) -> Balls:
    """Cells of about equal distance steps: ring i of a cell reaches i + 1 of ``rings`` parts of its radius."""
    check_metric(metric)
    centroids = train_cells(corpus, nlist, metric, seed) if centroids is None else centroids
    # What is searched are the vectors as given, so that scores are rounded as in exact search.
    rows = prepared(corpus.select(*KEYS, "document_id", "embedding", F.col("embedding").alias("_given")), metric)
    near = rows.withColumn("_cells", nearest_cells(rows, centroids, 1, "l2"))
    near = near.withColumn("cell", F.get("_cells", F.lit(0))).filter("cell is not null").drop("_cells")
    near = stored(near.withColumn("_far", _distance(near, centroids, metric)), "cell-distances")
    on = [*KEYS, "cell"]
    radius = near.groupBy(*on).agg(F.max(F.col("_far")[0]).alias("_radius"))  # a row per cell
    step = F.when(F.col("_radius") > 0, F.floor(F.col("_far")[0] / F.col("_radius") * rings)).otherwise(0)
    ring = F.col("cell") * rings + F.least(step, F.lit(rings - 1)).cast("int")
    celled = near.join(F.broadcast(radius), on).withColumn("ring", ring)
    bounds = [F.min(F.col("_far")[0]).alias("low"), F.max(F.col("_far")[0]).alias("high"), F.max(F.col("_far")[1]).alias("longest")]
    by: dict[tuple, list] = {}
    for r in celled.groupBy(*on, "ring").agg(*bounds).orderBy(*KEYS, "ring").collect():
        by.setdefault((r["dataset"], r["lang"]), []).append((r["ring"], r["cell"], r["low"], r["high"], r["longest"]))
    known = {key: Rings(*(np.array(c) for c in zip(*rows)), centroids[key]) for key, rows in by.items()}
    return Balls(celled.select(*KEYS, "document_id", F.col("_given").alias("embedding"), "ring"), known)


def _asked(queries: DataFrame, balls: Balls, metric: str, nprobe: int, rest: bool) -> DataFrame:
    """A row per query and ring: the ``nprobe`` best ones, or the others that reach the query's ``_floor``."""
    shared = queries.sparkSession.sparkContext.broadcast(balls.rings)

    @F.arrow_udf(INTS)
    def chosen(dataset: pa.Array, lang: pa.Array, vectors: pa.Array, floor: pa.Array) -> pa.Array:
        floors = floor.to_numpy(zero_copy_only=False).astype(float)

        def of(key, block):
            if key not in shared.value:
                return np.zeros((len(block), 0), np.int32)
            rings = shared.value[key]
            bounds = rings.bounds(as_indexed(block, metric), metric)
            first = np.argsort(-bounds, axis=1, kind="stable")[:, :nprobe]
            if not rest:
                return rings.ring[first]
            own = np.nan_to_num(floors[where[key]], nan=-np.inf)
            wanted = bounds >= own[:, None]
            np.put_along_axis(wanted, first, False, axis=1)
            return np.where(wanted, rings.ring[None, :], -1)

        where = pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices
        return _per_bundle(dataset, lang, vectors, of)

    rings = chosen.asNondeterministic()("dataset", "lang", "embedding", "_floor")
    asked = queries.withColumn("ring", F.explode(rings)).filter("ring >= 0")
    return asked if rest else asked.drop("_floor")


def balls_topk(
    queries: DataFrame, balls: Balls, k: int, metric: str = "cosine", nprobe: int = 4, counted: list | None = None, **physical
) -> DataFrame:
    """The exact best ``k`` of each query. ``counted`` gets the two tables of queries and rings that were searched."""
    ascending, keys = metric == "l2", [*KEYS, "ring"]
    queries = queries.select(*KEYS, "query_id", "embedding")
    near = _asked(queries.withColumn("_floor", F.lit(None).cast("double")), balls, metric, nprobe, rest=False)
    first = topk(near, balls.celled, k, Dense(metric), keys=keys, ascending=ascending, **physical)
    first = stored(first.drop("rank"), "first-rings")
    score = -F.col("score") if ascending else F.col("score")
    worst = first.groupBy(*KEYS, "query_id").agg(F.when(F.count(F.lit(1)) == k, F.min(score)).alias("_floor"))
    more = stored(_asked(queries.join(worst, [*KEYS, "query_id"], "left"), balls, metric, nprobe, rest=True), "more-rings")
    if counted is not None:
        counted += [near, more]
    second = topk(more, balls.celled, k, Dense(metric), keys=keys, ascending=ascending, **physical).drop("rank")
    return best(first.unionByName(second), k, ascending)


def searched_share(asked: list[DataFrame], balls: Balls) -> DataFrame:
    """Per bundle: pairs of a query and a document in a ring it searched, of all pairs."""
    sizes = balls.celled.groupBy(*KEYS, "ring").agg(F.count(F.lit(1)).alias("n"))
    pairs = asked[0].select(*KEYS, "query_id", "ring").unionByName(asked[1].select(*KEYS, "query_id", "ring"))
    met = pairs.join(sizes, [*KEYS, "ring"]).groupBy(*KEYS).agg(F.sum("n").alias("met"), F.count_distinct("query_id").alias("queries"))
    whole = sizes.groupBy(*KEYS).agg(F.sum("n").alias("documents"))
    return met.join(whole, KEYS).withColumn("share", F.col("met") / (F.col("queries") * F.col("documents")))
