"""Exact top-k inner products by MaxScore over posting lists.

A vector is a set of terms (dimension, weight); a term's postings are the rows that hold
it. The corpus is dealt by hash into shards of bounded rows, and every shard holds the
postings of its rows. For a query, a term's bound is the most that any of its postings
can add (0 if that is negative, because a row may lack the term). With the terms in order of
their bounds, the last ones whose bounds sum to less than the k-th best score so far are
the non-essential: a row found in none of the others cannot be among the best. The
essential postings are traversed; the non-essential are probed only for rows that can
still reach the k-th best score, the largest bound first, and rows fall out as
the remaining bounds shrink. Weights may be negative and scores are exact integers.

Each shard starts from a floor: the k-th best score of the query over a sixteenth of the
corpus, which is a lower bound whatever that part holds. So shards send little
more than what can win, and a window merges them. Queries come in blocks: every block
meets every shard, in a task of bounded size. No side is broadcast.

Rows without id, and vectors that are null or hold a null or a non-finite component take
no part. Vectors may differ in length; a missing component is a missing term. Rows that
repeat an id are rows of their own: they are queries and candidates each. Ties go to the
smaller id, then to the row stored first. An empty table gives an empty result. Sums of any size
are exact; a component, or one of the best scores, that no long holds is an error and never wraps round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from negsift.session import stored

SHARD_ROWS = 4096
QUERY_ROWS = 2048
BLOCK = 256  # queries per product
PROBE = 8  # terms probed before rows are dropped again
FLOOR_SHARE = 16
_FOUND = "query_row long, query_id long, row long, id long, score long"


def whole_weights(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, or null if the vector takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    beyond = F.raise_error(F.lit("a scaled component is beyond 64 bits")).cast("long")
    whole = lambda x: F.when(F.abs(x * scale) < float(1 << 63), F.floor(x * scale)).otherwise(beyond)
    return F.when(~F.exists(wide, odd), F.transform(wide, whole))


class Postings:
    """The posting lists of a shard: a row of weights per term, 0 where a row lacks the term."""

    def __init__(self, lists: pa.ListArray, terms: int):
        self.table = dense(lists, terms).T.copy()
        full = self.table if self.table.shape[1] else np.zeros((terms, 1), self.table.dtype)
        self.low, self.high = full.min(axis=1), full.max(axis=1)


def dense(lists: pa.ListArray, terms: int) -> np.ndarray:
    """Vectors as rows of a matrix of ``terms`` columns."""
    starts = lists.offsets.to_numpy()
    sizes = np.diff(starts)
    out = np.zeros((len(sizes), terms), np.int64)
    at = np.arange(starts[0], starts[-1])
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, at - starts[:-1][row]] = lists.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]]
    return out


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """Doubles hold every sum of products below 2^53 exactly, 64-bit integers below 2^63; else whole numbers of any size."""
    top = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    most = top(a) * top(b) * max(1, a.shape[1])
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Scores that are sent on, as 64-bit integers."""
    if scores.dtype == object and any(abs(x) >= 1 << 63 for x in scores):
        raise OverflowError("a score is beyond 64 bits; use a smaller scale")
    return scores.astype(np.int64)


def falling(scores: np.ndarray) -> np.ndarray:
    """Places of the scores, best first; equal scores share one."""
    return -scores if scores.dtype != object else -np.unique(scores, return_inverse=True)[1]


def search(postings: Postings, asked: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, row, score`` of all pairs that reach the query's floor (-inf: all pairs).

    Bounds are doubles. Where scores are too large for these to be exact, they are
    raised by more than rounding can take away, and a few pairs below the floor come out too.
    """
    kind = exact_type(asked, postings.table.T)
    table, weights = postings.table.astype(kind), asked.astype(kind)
    bounds = np.maximum(0, np.maximum(weights * postings.low, weights * postings.high))
    order = np.argsort(-bounds, axis=1, kind="stable")
    place = np.argsort(order, axis=1)  # of each term in its query's order
    ranked = np.take_along_axis(bounds, order, axis=1)
    rest = np.zeros((len(asked), asked.shape[1] + 1))  # what the terms from a place on can add
    rest[:, :-1] = np.cumsum(ranked[:, ::-1].astype(float), axis=1)[:, ::-1]
    if kind is not np.float64:
        most = np.maximum(np.abs(postings.low.astype(float)), np.abs(postings.high.astype(float)))
        rest += (np.abs(asked.astype(float)) @ most * 2.0**-40)[:, None]
    # The essential terms: up to the first place from which on the rest stays below the floor.
    reached = (rest >= floors[:, None]).sum(axis=1)
    reached = np.where(np.isinf(floors), asked.shape[1], np.minimum(reached, asked.shape[1]))
    score = np.where(place < reached[:, None], weights, 0) @ table
    # A row in none of their postings has score 0 so far, and cannot reach the floor.
    query, row = np.nonzero(score.astype(float) + rest[np.arange(len(asked)), reached][:, None] >= floors[:, None])
    while (reached < asked.shape[1]).any():
        after = np.minimum(reached + PROBE, asked.shape[1])
        if len(query) * PROBE > score.size:  # many rows compete: probe whole lists at once
            probed = (place >= reached[:, None]) & (place < after[:, None])
            score += np.where(probed, weights, 0) @ table
        else:
            for step in range(PROBE):
                at = np.minimum(reached + step, asked.shape[1] - 1)
                term = order[np.arange(len(asked)), at]
                weight = np.where(reached + step < after, weights[np.arange(len(asked)), term], 0)
                score[query, row] += weight[query] * table[term[query], row]
        reached = after
        left = rest[np.arange(len(asked)), reached]
        alive = score[query, row].astype(float) + left[query] >= floors[query]
        query, row = query[alive], row[alive]
    found = score[query, row]
    return query, row, found if kind is object else found.astype(np.int64)


def _meet(k: int):
    names = ["query_row", "query_id", "row", "id", "score"]

    def run(key: tuple, queries: pa.Table, shard: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if queries.num_rows and shard.num_rows:
            shard = shard.sort_by([("_id", "ascending"), ("_row", "ascending")])
            lists, asked = shard["_weights"].combine_chunks(), queries["_weights"].combine_chunks()
            terms = max(int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in (lists, asked))
            postings, asked = Postings(lists, terms), dense(asked, terms)
            rows, ids = shard["_row"].to_numpy(), shard["_id"].to_numpy()
            q_rows, q_ids = queries["_row"].to_numpy(), queries["_id"].to_numpy()
            floors = queries["_floor"].to_numpy().astype(float)
            floors = np.where(np.isnan(floors), -np.inf, np.nextafter(floors, -np.inf))
            for lo in range(0, len(asked), BLOCK):
                query, row, score = search(postings, asked[lo : lo + BLOCK], floors[lo : lo + BLOCK])
                query += lo
                other = rows[row] != q_rows[query]
                query, row, score = query[other], row[other], score[other]
                best = np.lexsort((row, falling(score), query))  # rows are in id order
                query, row, score = query[best], row[best], score[best]
                first = np.searchsorted(query, query)
                kept = np.arange(len(query)) - first < k
                query, row, score = query[kept], row[kept], score[kept]
                for column, values in zip(out, (q_rows[query], q_ids[query], rows[row], ids[row], as_longs(score))):
                    column.append(values)
        return pa.table({n: pa.array(np.concatenate([*c, np.zeros(0, np.int64)]), pa.int64()) for n, c in zip(names, out)})

    return run


def _found(queries: DataFrame, rows: DataFrame, k: int, shards: int, blocks: int) -> DataFrame:
    """What each pair of a query block and a shard sends to the merge."""
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = queries.withColumn("_block", deal("_row", blocks)).withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = rows.withColumn("_shard", deal("_row", shards)).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    at = ["_shard", "_block"]
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(_meet(k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def topk(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, id, score``: the k best other rows of each query row."""
    picked = vectors.select(F.col(id_col).cast("long").alias("_id"), whole_weights(F.col(vector_col), scale).alias("_weights"), is_query.alias("_asks"))
    rows = stored(picked.filter("_id is not null and _weights is not null").withColumn("_row", F.monotonically_increasing_id()), "postings")
    many, asked = rows.agg(F.count(F.lit(1)), F.count_if("_asks")).first()
    rows, queries = rows.drop("_asks"), rows.filter("_asks").drop("_asks")
    blocks = max(1, -(-asked // query_rows))
    part = rows.filter(F.pmod(F.xxhash64(F.lit(1), "_row"), F.lit(FLOOR_SHARE)) == 0)
    unbound = queries.withColumn("_floor", F.lit(None).cast("long"))
    first = _best(_found(unbound, part, k, max(1, -(-many // (FLOOR_SHARE * shard_rows))), blocks), k)
    floors = first.filter(F.col("rank") == k).select(F.col("query_row").alias("_row"), F.col("score").alias("_floor"))
    bound = queries.join(stored(floors, "floors"), "_row", "left").select(*unbound.columns)
    found = _found(bound, rows, k, max(1, -(-many // shard_rows)), blocks)
    return _best(found, k).select("query_id", "rank", "id", "score")
