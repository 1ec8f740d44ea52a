"""Top-k documents per query, for any way of scoring.

Every search here is one operator: rows of two tables meet under shared key
columns (a bundle, a bundle and a cell, a bundle and a hash bucket), a scorer
turns a chunk of queries and a chunk of documents into a score matrix, and only
the best k of each query leave the chunk. A window keeps the best k over all
chunks. Pairs are never rows; what a chunk emits is at most k per query.

Two physical forms, chosen by the measured size of the query side:

broadcast  The queries fit ``broadcast_bytes``, with what a task keeps for them. Each
           task reads its part of the corpus as Arrow batches; the documents do not move.
blocks     Otherwise both sides are split by id hash into blocks of bounded size
           under each key, queries are copied to the document blocks of their
           key, and the two meet in a cogroup. A key with a third of the corpus
           becomes many blocks and so many tasks. A block is about one ``SIDES``th of its
           table, so a row is copied to about as many blocks, however few rows a chunk has.
           Documents of a few numbers each (a scorer that is ``light``) are one block as long as they fit
           ``BLOCK_BYTES``: a query then meets all of them in one task, only its best k leave it, and the floor is what it has met so far.
           Spark joins small partitions by their bytes, but the work is in pairs, so from ``TASK_PAIRS`` pairs for each
           core on the meetings of blocks are numbered and dealt out in turn: a task has one meeting of two bounded blocks, or
           a few that have about ``TASK_PAIRS`` pairs together, however large the tables are.

A large search goes over the corpus twice: first over one in ``FLOOR_SHARE`` of its documents, whose
k-th best score is a floor under each query's result whatever the others hold. The whole
corpus is then searched with the floors, and a chunk emits nothing below them: about
``FLOOR_SHARE`` * k rows per query leave all chunks together, however many there are, and at most k
a block. With floors most pairs need no exact score: a scorer that has ``likely`` names the
few that can reach the floor from products in single precision and a bound of their error, and only those are
scored in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from negsift.operators.spread import spread_small
from negsift.schema import KEYS, SCORE_PLACES
from negsift.session import stored

BROADCAST_BYTES = 256 << 20
CHUNK_BYTES = 32 << 20
_MATRIX_CELLS = 2_000_000  # score matrix of one chunk, 16 MB of doubles
FLOOR_ROWS = 1_000_000  # documents from which on floors are looked for
FLOOR_PAIRS, FLOOR_LEAST = 250_000_000, 1 << 13  # or pairs, and documents at least
FLOOR_SHARE = 16
BLOCK_BYTES = 32 << 20  # queries, or documents, of one block at most
BLOCK_ROWS, SIDES = 4_096, 16  # rows of a block at least; else one in SIDES of the table
TASK_PAIRS = 1 << 26  # pairs that are worth a task
SLICE_ROWS, SLICES = 256, 4  # queries of a slice at least where all documents are one block; slices for each core until they have BLOCK_ROWS
HELD_HITS, HELD_LEAST = 4, 1 << 16  # hits of a block that are held until only the best are kept, in k for each query
MEASURED = 1_000  # documents whose mean size counts for all


def topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    scorer,
    keys: list[str] = KEYS,
    ascending: bool = False,
    once: bool = True,
    **physical,
) -> DataFrame:
    """Hits ``dataset, lang, query_id, document_id, score, rank`` of two tables.

    ``scorer.query_columns`` and ``scorer.doc_columns`` name the payload, and
    ``scorer.doc_block`` and ``scorer.query_block`` say how many rows of it make a
    chunk unless the caller does. Equal scores rank by ``document_id``. ``once`` says
    that no pair meets under two keys, or that the scorer gives it a score under one of them only
    (and no finite one elsewhere). ``physical`` goes to :func:`emitted`.
    """
    return best(emitted(queries, docs, k, scorer, keys, ascending, once, **physical), k, ascending, distinct=not once)


def emitted(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    scorer,
    keys: list[str] = KEYS,
    ascending: bool = False,
    once: bool = True,
    form: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    doc_block: int | None = None,
    query_block: int | None = None,
    spread: bool = True,
    floor_rows: int | None = None,
    floor_share: int = FLOOR_SHARE,
    block_rows: int | None = None,
    part: DataFrame | None = None,
) -> DataFrame:
    """What the scoring steps send to the final ranking: every hit of it, and some rows more.

    ``doc_block`` and ``query_block`` are the rows scored at once, ``block_rows`` those that are shuffled together.
    ``part`` is :func:`floor_part` of ``docs``, for a caller who has it for less than a filter on ``docs`` costs.
    Queries may come with a ``_floor``, a score (its negative if ``ascending``) that every hit still wanted reaches; then none are looked for.
    """
    given, doc_block = doc_block, doc_block or scorer.doc_block
    floored = "_floor" in queries.columns
    queries = queries.select(*keys, "query_id", *scorer.query_columns, *(["_floor"] if floored else []))
    docs = docs.select(*keys, "document_id", *scorer.doc_columns)
    if form not in ("auto", "broadcast", "blocks"):
        raise ValueError(f"unknown form: {form}")
    size, rows = size_in_bytes(queries)
    many = docs.select("document_id").count()
    large = many >= (FLOOR_ROWS if floor_rows is None else floor_rows)
    if floor_rows is None and many >= FLOOR_LEAST:
        large |= many * rows >= FLOOR_PAIRS
    some, measured = measured_bytes(docs)
    whole = form == "auto" and block_rows is None and floor_rows is None and getattr(scorer, "light", False) and many * some <= BLOCK_BYTES * measured
    if whole:
        form, large = "blocks", False
    if large and not floored:
        part = floor_part(docs, floor_share) if part is None else part.select(*docs.columns)
        options = {"form": form, "broadcast_bytes": broadcast_bytes, "doc_block": given, "query_block": query_block, "block_rows": block_rows}
        first = best(
            emitted(queries.withColumn("_floor", F.lit(None).cast("double")), part, k, scorer, keys, ascending, once, **options, spread=spread, floor_rows=1 << 62),
            k, ascending, distinct=not once,
        )
        floor = F.when(F.lit(ascending), -F.col("score")).otherwise(F.col("score"))
        floors = stored(first.filter(F.col("rank") == k).select(*KEYS, "query_id", floor.alias("_floor")), "floors")
        queries, floored = queries.join(floors, [*KEYS, "query_id"], "left"), True
    elif not floored:
        queries = queries.withColumn("_floor", F.lit(None).cast("double"))
    if form == "auto":
        # In a task: the queries, once more as doubles and as floats, and the best k of each.
        form = "broadcast" if 4 * size + 8 * k * rows <= broadcast_bytes else "blocks"
    search = _Search(scorer, k, keys, ascending, doc_block, query_block, pair_schema(queries, keys), floored or given is None)
    if form == "broadcast":
        return _against_broadcast(queries, spread_small(docs) if spread else docs, search)
    if whole:
        tasks = SLICES * queries.sparkSession.sparkContext.defaultParallelism
        doc_rows, query_rows = max(1, many), max(SLICE_ROWS, min(BLOCK_ROWS, rows // tasks))
    else:
        doc_rows, query_rows = block_rows or _block(many, some, measured), block_rows or _block(rows, size, rows)
    search.tasks = _tasks(queries.sparkSession, many, rows, doc_rows, query_rows)
    return _against_blocks(queries, docs, search, doc_rows, query_rows)


def floor_part(docs: DataFrame, share: int = FLOOR_SHARE) -> DataFrame:
    """The documents on which floors are found, one in ``share`` by hash of their id."""
    return docs.filter(F.pmod(F.xxhash64(F.lit("floor"), "document_id"), F.lit(share)) == 0)


def _block(total: int, size: int, rows: int) -> int:
    """Rows of a block of a table of ``total`` rows, ``rows`` of which have ``size`` bytes."""
    return max(1, min(BLOCK_BYTES * rows // max(size, 1), max(BLOCK_ROWS, total // SIDES)))


def _tasks(spark: SparkSession, many: int, rows: int, doc_rows: int, query_rows: int) -> int:
    """Partitions for the meetings of the blocks of two tables; 0 where they are few pairs and Spark may join them.

    At least as many as Spark would make, since tables of many keys have more meetings than one of all their rows.
    """
    tasks = min(-(-many // doc_rows) * -(-rows // query_rows), many * rows // TASK_PAIRS)
    return max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))) if tasks > spark.sparkContext.defaultParallelism else 0


def best(found: DataFrame, k: int, ascending: bool = False, distinct: bool = False) -> DataFrame:
    """The k best of each query; Spark limits each task's share before the shuffle."""
    if distinct:
        pick = F.min("score") if ascending else F.max("score")
        found = found.groupBy(*KEYS, "query_id", "document_id").agg(pick.alias("score"))
    order = F.asc("score") if ascending else F.desc("score")
    rank = F.row_number().over(W.partitionBy(*KEYS, "query_id").orderBy(order, "document_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def size_in_bytes(rows: DataFrame) -> tuple[int, int]:
    """Bytes of a table in memory, from the lengths of its values, and its rows."""
    found = rows.agg(F.sum(row_bytes(rows)), F.count(F.lit(1))).first()
    return found[0] or 0, found[1]


def measured_bytes(rows: DataFrame, most: int = MEASURED) -> tuple[int, int]:
    """The same of ``most`` rows. Only sizes leave the tasks, and no more partitions are looked at than have these rows:
    a limit below an aggregation would make, and shuffle, so many rows of every partition."""
    found = rows.select(row_bytes(rows).alias("n")).take(most)
    return sum(r["n"] for r in found), len(found)


def row_bytes(rows: DataFrame) -> Column:
    size = F.lit(0).cast("long")
    for field in rows.schema.fields:
        kind = field.dataType.simpleString()
        if kind.startswith("array<array"):
            one = F.size(F.flatten(field.name)) * 4 + F.size(field.name) * 8
        elif kind.startswith("array"):
            one = F.size(field.name) * 4
        elif kind == "string":
            one = F.octet_length(field.name)
        else:
            one = F.lit(8)
        size = size + F.coalesce(one.cast("long"), F.lit(0))
    return size


def pair_schema(queries: DataFrame, keys: list[str]) -> str:
    types = dict(queries.dtypes)
    return ", ".join(f"{c} {types[c]}" for c in KEYS) + ", query_id string, document_id string, score double"


def rounded(scores: np.ndarray, query_powers: np.ndarray, doc_powers: np.ndarray) -> np.ndarray:
    """Scores to SCORE_PLACES places below the size of their pair, a power of ten per side."""
    if not query_powers.any() and not doc_powers.any():
        return np.round(scores, SCORE_PLACES) + 0.0
    factor = 10.0 ** (SCORE_PLACES - query_powers[:, None].astype(float) - doc_powers[None, :])
    return np.rint(scores * factor) / factor + 0.0


def rounded_pairs(scores: np.ndarray, query_powers: np.ndarray, doc_powers: np.ndarray) -> np.ndarray:
    """The same for one score per pair."""
    factor = 10.0 ** (SCORE_PLACES - query_powers.astype(float) - doc_powers)
    return np.rint(scores * factor) / factor + 0.0


def best_rows(row: np.ndarray, col: np.ndarray, signed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are the best ``k`` of their row, in order, and their places from 0; ties by column."""
    order = np.lexsort((col, -signed, row))
    starts = np.flatnonzero(np.diff(row[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k], place[place < k]


class _Side:
    """The queries of one key, ready for scoring, and what a document must reach."""

    def __init__(self, search: "_Search", key: tuple, left: pa.Table, keep: bool):
        self.ids, self.rows = left["query_id"].combine_chunks(), left.num_rows
        self.q = search.scorer.queries(left, key)
        self.powers = search.scorer.query_powers(self.q)
        self.floor = left["_floor"].to_numpy().astype(np.float64)
        self.floor[np.isnan(self.floor)] = -np.inf
        self.kept = np.full((self.rows, search.k), -np.inf) if keep else None

    def learn(self, at, top: np.ndarray) -> None:
        """Scores of the rows ``at``: no later hit is below the k-th best so far."""
        if self.kept is not None:
            k = self.kept.shape[1]
            self.kept[at] = np.partition(np.hstack([self.kept[at], top]), -k, axis=1)[:, -k:]
            self.floor[at] = np.maximum(self.floor[at], self.kept[at].min(axis=1))


class _Search:
    """The work of one task: chunks in, the best k of each query out."""

    def __init__(self, scorer, k, keys, ascending, doc_block, query_block, schema, merged):
        self.scorer, self.k, self.keys = scorer, k, keys
        self.ascending, self.doc_block, self.schema, self.merged = ascending, doc_block, schema, merged
        self.query_block = query_block or 1 << 62
        self.tasks = 0

    def run(self, key: tuple, left: pa.Table, right: pa.Table, kept: dict | None = None) -> Iterator[pa.RecordBatch]:
        """Score all ``left`` queries against all ``right`` documents of one key.

        Nothing below a query's floor goes out. A task that scores several chunks for the
        same queries passes ``kept``: the queries as arrays, and the best k scores so far; rows below
        the k-th of them cannot be among the best and stay in the task. Ties go out, the
        final ranking decides on them. Of a block that came with floors only the best k of each query go out.
        """
        if left.num_rows == 0 or right.num_rows == 0:
            return
        side = None if kept is None else kept.get(key)
        if side is None:
            side = _Side(self, key, left, keep=kept is not None or self.merged)
            if kept is not None:
                kept[key] = side
        right = right.sort_by("document_id")
        doc_ids, whole = right["document_id"].combine_chunks(), kept is None and self.merged
        held, at, size, many = [], 0, 0, 0
        while (at := at + size) < right.num_rows:
            # Until queries have floors every pair gets an exact score, so a scorer may ask for fewer; where the floors
            # are found in the block itself it takes no more documents at once than have told of them.
            size, first = self.doc_block, getattr(self.scorer, "first_block", self.doc_block)
            if not np.isfinite(side.floor).all():
                size = min(size, first)
            elif whole and getattr(self.scorer, "light", False):
                size = min(size, max(at, first))
            for row, col, scores in self._chunk(key, side, right.slice(at, size)):
                if whole:
                    held.append((row, col + at, scores))
                    many += len(row)
                    if many > max(HELD_HITS * side.rows * self.k, HELD_LEAST):
                        held = [self._best_of(side, held)]
                        many = len(held[0][0])
                elif len(row):
                    yield self._out(key, side, doc_ids, row, col + at, scores)
        if held:
            yield self._out(key, side, doc_ids, *self._best_of(side, held))

    def _best_of(self, side: _Side, held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best k of each query among the hits held of a block."""
        row, col, scores = (np.concatenate(c) for c in zip(*held))
        reach = (-scores if self.ascending else scores) >= side.floor[row]
        row, col, scores = row[reach], col[reach], scores[reach]
        chosen, _ = best_rows(row, col, -scores if self.ascending else scores, self.k)
        return row[chosen], col[chosen], scores[chosen]

    def _out(self, key: tuple, side: _Side, doc_ids: pa.Array, row: np.ndarray, col: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
        columns = [pa.repeat(value, len(row)) for value in key[: len(KEYS)]]
        columns += [side.ids.take(pa.array(row)), doc_ids.take(pa.array(col)), pa.array(scores)]
        return pa.RecordBatch.from_arrays(columns, names=[*KEYS, "query_id", "document_id", "score"])

    def _chunk(self, key: tuple, side: _Side, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of queries, rows of documents and scores of what a chunk sends on."""
        scorer = self.scorer
        places = scorer.live(side.q, right, key) if hasattr(scorer, "live") else None
        if places is not None:
            right = right.take(pa.array(places))
        if not right.num_rows:
            return
        d = scorer.docs(right, key)
        powers = scorer.doc_powers(d)
        step = min(max(1, _MATRIX_CELLS // right.num_rows), self.query_block)
        for start in range(0, side.rows, step):
            stop = min(start + step, side.rows)
            floor, near = side.floor[start:stop], None
            if hasattr(scorer, "likely") and np.isfinite(floor).all():
                near = scorer.likely(side.q, start, stop, d, floor, self.k)
            row, col, scores = self._all(side, start, stop, d, powers) if near is None else self._some(side, start, stop, d, powers, *near)
            yield row + start, col if places is None else places[col], scores

    def _all(self, side: _Side, start: int, stop: int, d, powers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scores = rounded(self.scorer.score(side.q, start, stop, d), side.powers[start:stop], powers)
        signed = -scores if self.ascending else scores
        chosen, top = self._select(signed)
        chosen &= (signed >= side.floor[start:stop, None]) & (signed > -np.inf)
        side.learn(slice(start, stop), top)
        row, col = np.nonzero(chosen)
        return row, col, scores[row, col]

    def _some(self, side: _Side, start: int, stop: int, d, powers: np.ndarray, row: np.ndarray, col: np.ndarray):
        """Of pairs that may reach their floor, those that do."""
        scores = rounded_pairs(self.scorer.pairs(side.q, row + start, d, col), side.powers[row + start], powers[col])
        signed = -scores if self.ascending else scores
        reach = (signed >= side.floor[row + start]) & (signed > -np.inf)
        row, col, scores, signed = row[reach], col[reach], scores[reach], signed[reach]
        chosen, place = best_rows(row, col, signed, self.k)
        row, col, scores, signed = row[chosen], col[chosen], scores[chosen], signed[chosen]
        if len(row):
            each, inverse = np.unique(row, return_inverse=True)
            top = np.full((len(each), place.max() + 1), -np.inf)
            top[inverse, place] = signed
            side.learn(each + start, top)
        return row, col, scores

    def _select(self, signed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which cells hold the best k of their row, and the scores in them.

        Columns are in id order, so among equal scores at the boundary the first
        columns win.
        """
        if signed.shape[1] <= self.k:
            return np.ones(signed.shape, dtype=bool), signed
        top = np.partition(signed, -self.k, axis=1)[:, -self.k :]
        bound = top.min(axis=1, keepdims=True)
        chosen = signed >= bound
        more = np.flatnonzero(chosen.sum(axis=1) > self.k)
        if len(more):
            above, tied = signed[more] > bound[more], signed[more] == bound[more]
            room = self.k - above.sum(axis=1, keepdims=True)
            chosen[more] = above | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= room))
        return chosen, top


def groups(table: pa.Table, keys: list[str]):
    """Rows of an Arrow table per key."""
    where = table.select(keys).to_pandas().groupby(keys, sort=False).indices
    for key, rows in where.items():
        yield key if isinstance(key, tuple) else (key,), table.take(pa.array(rows))


def _against_broadcast(queries: DataFrame, docs: DataFrame, search: _Search) -> DataFrame:
    # At most broadcast_bytes, measured by the caller.
    by_key = dict(groups(queries.toArrow(), search.keys))
    shared = queries.sparkSession.sparkContext.broadcast(by_key)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, kept = [], 0, 0, {}
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            size += batch.nbytes
            if rows >= search.doc_block or size >= CHUNK_BYTES:
                yield from score(held, kept)
                held, rows, size = [], 0, 0
        if held:
            yield from score(held, kept)

    def score(held: list[pa.RecordBatch], kept: dict) -> Iterator[pa.RecordBatch]:
        for key, part in groups(pa.Table.from_batches(held), search.keys):
            if key in shared.value:
                yield from search.run(key, shared.value[key], part, kept)

    return docs.mapInArrow(scan, search.schema)


def _against_blocks(
    queries: DataFrame, docs: DataFrame, search: _Search, doc_rows: int, query_rows: int
) -> DataFrame:
    keys = search.keys
    # Only keys with more than one block are listed: at most one row per
    # doc_rows documents or query_rows queries, which bounds the broadcast.
    doc_sizes = docs.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / doc_rows).cast("int").alias("_blocks"))
    query_sizes = queries.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("_slices"))
    many_blocks = F.broadcast(doc_sizes.filter("_blocks > 1"))
    many_slices = F.broadcast(query_sizes.filter("_slices > 1"))

    def sized(rows: DataFrame) -> DataFrame:
        return (
            rows.join(many_blocks, keys, "left")
            .join(many_slices, keys, "left")
            .fillna(1, ["_blocks", "_slices"])
        )

    def dealt(rows: DataFrame) -> DataFrame:
        """Meetings of a key have consecutive numbers, from one that its hash gives."""
        if search.tasks:
            number = F.xxhash64(*keys) % search.tasks + F.col("_slice") * F.col("_blocks") + F.col("_block")
            rows = rows.withColumn("_task", F.pmod(number, F.lit(search.tasks)).cast("int")).repartitionById(search.tasks, "_task")
        return rows.drop("_blocks", "_slices")

    def spread(id_col: str, count: str):
        return F.pmod(F.xxhash64(id_col), F.col(count)).cast("int")

    left = (
        sized(queries)
        .withColumn("_slice", spread("query_id", "_slices"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    )
    right = (
        sized(docs)
        .withColumn("_block", spread("document_id", "_blocks"))
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    )
    at = [*keys, *(["_task"] if search.tasks else []), "_slice", "_block"]
    # Both sides may come from one table; fresh aliases keep their columns apart.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    left, right = dealt(left), dealt(right)

    def meet(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        plain = tuple(value.as_py() for value in key[: len(keys)])
        found = list(search.run(plain, a, b))
        return pa.Table.from_batches(found) if found else EMPTY

    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(meet, search.schema)


EMPTY = pa.table(
    {
        **{c: pa.array([], pa.string()) for c in [*KEYS, "query_id", "document_id"]},
        "score": pa.array([], pa.float64()),
    }
)
