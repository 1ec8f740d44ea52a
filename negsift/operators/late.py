"""Late interaction over token vectors: exact, and pruned by token centroids.

Both tables hold ``tokens``, an array of vectors per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from negsift.operators.cells import INTS, Matrices, nearest_cells, train_cells
from negsift.operators.scorers import PAIRED, CentroidMaxSim, MaxSim, Ragged, SharedCell, SmallestCell, matrix, runs, sum_per_text
from negsift.operators.topk import BLOCK_BYTES, BROADCAST_BYTES, EMPTY, best, groups, measured_bytes, pair_schema, rounded_pairs, size_in_bytes, topk
from negsift.schema import KEYS
from negsift.session import stored


def maxsim_topk(queries: DataFrame, corpus: DataFrame, k: int, **physical) -> DataFrame:
    """For each query token the best document token, summed; best ``k`` documents."""
    return topk(queries, corpus, k, MaxSim(), **physical)


def _each_token(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(*KEYS, id_col, F.explode("tokens").alias("embedding"))


def token_codes(corpus: DataFrame, centroids: Matrices) -> Column:
    """The centroid of each of the ``tokens`` of each document."""
    shared = corpus.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf(INTS)
    def assign(dataset: pa.Array, lang: pa.Array, texts: pa.Array) -> pa.Array:
        ragged = Ragged(pa.chunked_array([texts]))
        out = np.zeros(len(ragged.tokens), np.int32)
        text = np.repeat(np.arange(len(ragged.counts)), ragged.counts)
        bundles = pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices
        for key, at in bundles.items():
            centroids = shared.value[key]
            own = np.flatnonzero(np.isin(text, at)) if len(bundles) > 1 else np.arange(len(out))
            step = max(1, MaxSim.cells // len(centroids))
            for lo in range(0, len(own), step):
                some = own[lo : lo + step]
                out[some] = (ragged.tokens[some] @ centroids.T).argmax(1)
        return pa.ListArray.from_arrays(pa.array(ragged.starts.astype(np.int32)), pa.array(out))

    return assign.asNondeterministic()("dataset", "lang", "tokens")


def _wanted_scores(q: Ragged, at: np.ndarray, d: Ragged, i: int) -> np.ndarray:
    """Rounded scores of the queries ``at`` against document ``i``, in bounded products."""
    out = np.zeros(len(at))
    own = d.tokens[d.starts[i] : d.starts[i + 1]]
    if len(own):
        sizes = q.counts[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for lo, hi in runs(ends, max(1, MaxSim.cells // len(own))):
            rows = np.concatenate([np.arange(q.starts[j], q.starts[j + 1]) for j in at[lo:hi]] or [np.zeros(0, np.int64)])
            if len(rows):
                best = (q.tokens[rows] @ own.T).max(axis=1)
                out[lo:hi] = sum_per_text(best[:, None], ends[lo : hi + 1] - ends[lo], sizes[lo:hi])[:, 0]
    return out


def _pair_scores(q: Ragged, at: np.ndarray, d: Ragged, row: np.ndarray) -> np.ndarray:
    """Rounded scores of the queries ``at`` against the documents ``row``, pair by pair; pairs of a document stand together."""
    out = np.zeros(len(at))
    if q.each and d.each and q.tokens.shape[1] == d.tokens.shape[1]:
        asked, held = q.tokens.reshape(len(q.counts), q.each, -1), d.tokens.reshape(len(d.counts), d.each, -1)
        step = max(1, PAIRED // asked[:1].size)
        for lo in range(0, len(at), step):
            some = slice(lo, lo + step)
            a, b = asked[at[some]], held[row[some]]
            out[some] = sum(np.max([np.einsum("ij,ij->i", a[:, i], b[:, j]) for j in range(d.each)], axis=0) for i in range(q.each))
    else:
        ends = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
        for lo, hi in zip(ends[:-1], ends[1:]):
            out[lo:hi] = _wanted_scores(q, at[lo:hi], d, row[lo])
    return rounded_pairs(out, q.powers_at(at), d.powers_at(row))


#: Queries that one row lists for a document; a document that more want has more rows.
WANTED = 1024
#: Pairs that are scored, and leave a task, together.
SCORED = 1 << 16
#: What a task holds of the queries, over their size: they are doubles there, and come with their ids.
HELD = 4
#: Bytes of a query's id in a list.
ID_BYTES = 16


class _Asked:
    """Token vectors of queries, found by id."""

    def __init__(self, part: pa.Table):
        if part["query_id"].null_count:
            part = part.filter(pc.is_valid(part["query_id"]))
        coded = part["query_id"].combine_chunks().dictionary_encode()
        own = coded.indices.to_numpy()
        self.q, self.ids, self.rows = Ragged(part["tokens"]), coded.dictionary, np.argsort(own, kind="stable")
        self.ends = np.searchsorted(own[self.rows], np.arange(len(self.ids) + 1))

    def find(self, wanted: pa.Array, every: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``wanted``, and the queries there: of an id that repeats all, or the last one."""
        place = pc.index_in(wanted, value_set=self.ids)
        at = np.flatnonzero(pc.is_valid(place).to_numpy(zero_copy_only=False))
        place = place.take(pa.array(at)).to_numpy()
        first, last = self.ends[place], self.ends[place + 1]
        if not every:
            return at, self.rows[last - 1]
        many = last - first
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.rows[np.repeat(first, many) + inside]


def _scored(lists: pa.RecordBatch, bundles: dict[tuple, _Asked], every: bool) -> Iterator[pa.RecordBatch]:
    """Scores of documents ``_d`` against the ``_queries`` that they list, about ``SCORED`` pairs at a time."""
    sizes = pc.list_value_length(lists["_queries"]).to_numpy(zero_copy_only=False)
    for lo, hi in runs(np.concatenate([[0], np.cumsum(sizes)]), SCORED):
        some = lists.slice(lo, hi - lo)
        wanted, row = some["_queries"].flatten(), np.repeat(np.arange(hi - lo), sizes[lo:hi])
        d = Ragged(pa.chunked_array([some["_d"]]))
        for key, rows in some.select(KEYS).to_pandas().groupby(KEYS).indices.items():
            if key not in bundles:
                continue
            own = np.flatnonzero(np.isin(row, rows)) if len(rows) < hi - lo else np.arange(len(row))
            place, at = bundles[key].find(wanted.take(pa.array(own)), every)
            place, of = pa.array(own[place]), row[own[place]]
            scores, documents = _pair_scores(bundles[key].q, at, d, of), pa.array(of)
            columns = [some[c].take(documents) for c in KEYS] + [wanted.take(place), some["document_id"].take(documents), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*KEYS, "query_id", "document_id", "score"])


def exact_scores(candidates: DataFrame, queries: DataFrame, corpus: DataFrame, broadcast_bytes: int, tokens: Column | None = None) -> DataFrame:
    """Late-interaction scores of given pairs.

    ``tokens`` are those of a document, by default its column of this name; they are made for
    documents that are wanted and for no other.

    Token vectors are far larger than ids, so they should not travel once per pair:
    a document's tokens meet lists of up to about ``WANTED`` ids of queries that want it. While the
    queries fit a broadcast, with what a task makes of them, their tokens are looked up; beyond that they are cut by id hash into
    slices of ``BLOCK_BYTES``, a document has lists for each slice, and a slice meets buckets of lists of about as many bytes.
    Both ways score by the same steps, some pairs at a time.
    """
    pairs = candidates.select(*KEYS, "query_id", "document_id")
    queries = queries.select(*KEYS, "query_id", "tokens")
    payload = ["tokens"] if tokens is None else [c for c in ("codes", "packed") if c in corpus.columns]
    documents = corpus.select(*KEYS, "document_id", *[F.col(c).alias("_d") if c == "tokens" else c for c in payload])
    size, _ = size_in_bytes(queries)
    small = HELD * size <= broadcast_bytes
    slices = 1 if small else max(1, -(-size // BLOCK_BYTES))
    sliced = lambda rows: rows.withColumn("_slice", F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int"))

    on, pairs = [*KEYS, "document_id"], sliced(pairs)
    counts = pairs.groupBy(*on, "_slice").agg(F.ceil(F.count(F.lit(1)) / WANTED).cast("int").alias("_n")).filter("_n > 1")
    part = F.pmod(F.xxhash64(F.lit("part"), "query_id"), F.coalesce("_n", F.lit(1)))
    wanted = pairs.join(counts, [*on, "_slice"], "left").withColumn("_part", part)
    wanted = wanted.groupBy(*on, "_slice", "_part").agg(F.collect_list("query_id").alias("_queries"))
    opened = (lambda rows: rows) if tokens is None else (lambda rows: rows.withColumn("_d", tokens))
    met = opened(wanted.join(documents, on))
    if small:
        by_bundle = {key: _Asked(part) for key, part in groups(queries.toArrow(), KEYS)}
        shared = queries.sparkSession.sparkContext.broadcast(by_bundle)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _scored(batch, shared.value, every=False)

        return met.select(*on, "_queries", "_d").mapInArrow(score, pair_schema(queries, KEYS))

    some, measured = measured_bytes(opened(documents).select("_d"))
    many, held = pairs.count(), documents.select("document_id").count()
    lists = many * ID_BYTES + min(many, held * slices) * some // max(measured, 1)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, -(-lists // (slices * BLOCK_BYTES)), cores // slices)
    bucket = F.pmod(F.xxhash64(F.lit("bucket"), "document_id", "_part"), F.lit(buckets)).cast("int")
    at = [*KEYS, "_slice", "_bucket"]
    left = sliced(queries).withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    right = met.withColumn("_bucket", bucket).select(*[F.col(c).alias(c) for c in [*at, "document_id", "_queries", "_d"]])

    def meet(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        found = []
        if a.num_rows and b.num_rows:
            bundles = {tuple(value.as_py() for value in key[: len(KEYS)]): _Asked(a)}
            for batch in b.to_batches():
                found += _scored(batch, bundles, every=True)
        return pa.Table.from_batches(found) if found else EMPTY

    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(meet, pair_schema(queries, KEYS))


def closest(tokens: DataFrame, centroids: Matrices) -> Column:
    """The largest product of a token with a centroid of its bundle."""
    shared = tokens.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf(T.DoubleType())
    def product(dataset: pa.Array, lang: pa.Array, vectors: pa.Array) -> pa.Array:
        block = matrix(pa.chunked_array([vectors]))
        out = np.full(len(block), -np.inf)
        for key, at in pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices.items():
            if key in shared.value:
                out[at] = (block[at] @ shared.value[key].T).max(axis=1)
        return pa.array(out)

    return product("dataset", "lang", "embedding")


def token_probes(queries: DataFrame, centroids: Matrices, nprobe: int, least: float | None = None) -> DataFrame:
    """``queries`` with a row per ``cell`` that is among the ``nprobe`` closest of one of its tokens, and all of them in ``cells``.

    A token whose product with its closest centroid is below ``least`` asks for none.
    """
    tokens = _each_token(queries, "query_id")
    if least is not None:
        tokens = tokens.filter(closest(tokens, centroids) >= least)
    near = tokens.withColumn("cells", nearest_cells(tokens, centroids, nprobe, "ip"))
    each = near.select(*KEYS, "query_id", F.explode("cells").alias("cell"))
    cells = each.groupBy(*KEYS, "query_id").agg(F.sort_array(F.collect_set("cell")).alias("cells"))  # as many as there are centroids
    return cells.join(queries.select(*KEYS, "query_id", "tokens"), [*KEYS, "query_id"]).withColumn("cell", F.explode("cells"))


#: Pairs that meet in cells, as a share of all pairs, from which on these meet under their bundle.
MET_SHARE = 1 / 8


def shared_topk(probe: DataFrame, celled: DataFrame, k: int, scorer, many: int, **physical) -> DataFrame:
    """Hits among the pairs that share one of ``many`` cells.

    Both tables have a row for each ``cell`` of a query or document, and all of them in ``cells``. The cell is a key of the
    search, unless most pairs would meet, some of them in several cells: then each query and document comes once, and pairs
    that share no cell are left out where they are scored.
    """
    keys = [*KEYS, "cell"]
    once = lambda rows: rows.filter(F.col("cell") == F.array_min("cells"))
    first = (F.col("cell") == F.array_min("cells")).cast("long")
    sizes = lambda rows, name: rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name), F.sum(first).alias(f"{name}_once"))
    each = sizes(probe, "q").join(sizes(celled, "d"), keys, "full").fillna(0)  # a row per cell
    bundles = each.groupBy(*KEYS).agg(F.sum(F.col("q") * F.col("d")).alias("met"), (F.sum("q_once") * F.sum("d_once")).alias("pairs"))
    met, pairs = bundles.agg(F.sum("met"), F.sum("pairs")).first()
    if pairs and met >= MET_SHARE * pairs:
        return topk(once(probe), once(celled), k, SharedCell(scorer, many), **physical)
    return topk(probe, celled, k, SmallestCell(scorer), keys=keys, **physical)


def most_cells(centroids: Matrices) -> int:
    return max((len(block) for block in centroids.values()), default=0)


def plaid_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    nlist: int = 100,
    nprobe: int = 2,
    full_scores: int | None = -1,
    centroids: Matrices | None = None,
    seed: int = 42,
    **physical,
) -> DataFrame:
    """Late interaction in two steps.

    Each query token names its ``nprobe`` closest token centroids. Documents with
    a token in one of them are scored by centroids only, and the best
    ``full_scores`` of a query are scored exactly. -1 stands for
    ``max(4 * k, 256)``; None scores every candidate exactly.

    The first step is :func:`shared_topk`: with the centroid as a key a
    centroid that holds a third of the corpus is many blocks, and a pair is scored under the smallest
    centroid that it meets in.
    """
    if centroids is None:
        centroids = train_cells(_each_token(corpus, "document_id"), nlist, "ip", seed)
    probe = token_probes(queries, centroids, nprobe)
    codes = corpus.select(*KEYS, "document_id", "tokens", token_codes(corpus, centroids).alias("codes"))
    codes = codes.withColumn("cells", F.array_distinct("codes"))
    cells = most_cells(centroids)
    if full_scores is None:
        return shared_topk(probe, codes.withColumn("cell", F.explode("cells")), k, MaxSim(), cells, **physical)
    probe, codes = stored(probe, "probes"), stored(codes.drop("tokens"), "codes")
    keep = max(4 * k, 256) if full_scores == -1 else full_scores
    shared = corpus.sparkSession.sparkContext.broadcast(centroids)
    found = shared_topk(probe, codes.withColumn("cell", F.explode("cells")), keep, CentroidMaxSim(shared), cells, **physical)
    candidates = stored(found.select(*KEYS, "query_id", "document_id"), "candidates")
    limit = physical.get("broadcast_bytes", BROADCAST_BYTES)
    return best(exact_scores(candidates, queries, corpus, limit), k)
