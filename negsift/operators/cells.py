"""Cells, codes and buckets: what the approximate searches partition a corpus by."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from negsift.functions.vectors import l2_normalize
from negsift.operators import lloyd
from negsift.operators.scorers import Dense, ProductCodes, check_metric, inner_or_distance, matrix, unit
from negsift.operators.topk import topk
from negsift.schema import KEYS
from negsift.session import stored

Matrices = dict[tuple[str, str], np.ndarray]

# Fixed value: a product-quantiser code has eight bits.
CODES = 256

INTS = T.ArrayType(T.IntegerType())


def bundles_of(rows: DataFrame) -> list[tuple[str, str, int]]:
    """Name and size of each bundle: as many rows as the run has languages."""
    return [tuple(r) for r in rows.groupBy(*KEYS).count().orderBy(*KEYS).collect()]


def cell_count(nlist: int, documents: int) -> int:
    return min(nlist, max(documents // 10, 1))


def train_cells(corpus: DataFrame, nlist: int, metric: str = "cosine", seed: int = 42, turns: int = lloyd.TURNS) -> Matrices:
    """Centroids per bundle, of all bundles together: each turn reads the whole corpus once."""
    ready = prepared(corpus, metric).select(*KEYS, "embedding")
    wanted = {(dataset, lang): cell_count(nlist, n) for dataset, lang, n in bundles_of(ready)}
    if not wanted:
        return {}
    sample = lloyd.some_rows(ready, lloyd.SAMPLE * max(wanted.values()), seed)
    seeds = {key: lloyd.far_seeds(sample[key], k, seed) for key, k in wanted.items()}
    return lloyd.lloyd(ready, seeds, turns)


def as_indexed(block: np.ndarray, metric: str) -> np.ndarray:
    return unit(block) if check_metric(metric) == "cosine" else block


def prepared(rows: DataFrame, metric: str) -> DataFrame:
    """The same as a column: unit length for cosine."""
    check_metric(metric)
    vector = l2_normalize(F.col("embedding")) if metric == "cosine" else F.col("embedding").cast("array<double>")
    return rows.withColumn("embedding", vector)


def nearest_cells(rows: DataFrame, centroids: Matrices, n: int, metric: str) -> Column:
    """The ``n`` closest cells of each vector, best first.

    Centroids are broadcast; their number is a parameter and not a function of
    the data.
    """
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf(INTS)
    def assign(dataset: pa.Array, lang: pa.Array, vectors: pa.Array) -> pa.Array:
        def nearest(key, block):
            if key not in shared.value:  # a bundle without documents has no cells
                return np.zeros((len(block), 0), np.int32)
            near = inner_or_distance(as_indexed(block, metric), shared.value[key], metric)
            return np.argsort(near if metric == "l2" else -near, axis=1, kind="stable")[:, :n]

        return _per_bundle(dataset, lang, vectors, nearest)

    # So marked, the cells are computed once and not again in the null check that
    # Spark derives from using them as a key.
    return assign.asNondeterministic()("dataset", "lang", "embedding")


def _per_bundle(dataset: pa.Array, lang: pa.Array, vectors: pa.Array, work) -> pa.Array:
    """``work(bundle, matrix)`` gives a row of ints per vector; back in row order."""
    bundles = pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices
    found = [(at, work(key, matrix(pa.chunked_array([vectors.take(pa.array(at))])))) for key, at in bundles.items()]
    widths = np.zeros(len(vectors), np.int64)
    for at, rows in found:
        widths[at] = rows.shape[1]
    starts = np.concatenate([[0], np.cumsum(widths)])
    flat = np.zeros(starts[-1], np.int32)
    for at, rows in found:
        flat[starts[at][:, None] + np.arange(rows.shape[1])] = rows
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))


def with_cell(corpus: DataFrame, centroids: Matrices, metric: str = "cosine") -> DataFrame:
    """The corpus with the ``cell`` of each document."""
    near = corpus.withColumn("cells", nearest_cells(corpus, centroids, 1, metric))
    return near.withColumn("cell", F.get("cells", F.lit(0))).drop("cells")


def probes(queries: DataFrame, centroids: Matrices, nprobe: int, metric: str = "cosine") -> DataFrame:
    """One row per query and cell to search."""
    near = queries.withColumn("cells", nearest_cells(queries, centroids, nprobe, metric))
    return near.withColumn("cell", F.explode("cells")).drop("cells")


def ivf_topk(
    queries: DataFrame,
    celled: DataFrame,
    centroids: Matrices,
    k: int,
    nprobe: int = 10,
    metric: str = "cosine",
    **physical,
) -> DataFrame:
    """Exact search inside the ``nprobe`` cells closest to each query."""
    return topk(
        probes(queries, centroids, nprobe, metric),
        celled,
        k,
        Dense(metric),
        keys=[*KEYS, "cell"],
        ascending=metric == "l2",
        **physical,
    )


# --- saved index -----------------------------------------------------------------


def save_index(
    celled: DataFrame,
    centroids: Matrices,
    path: str,
    codebooks: dict[tuple[str, str], list[np.ndarray]] | None = None,
    rows_per_file: int = 200_000,
) -> None:
    """Centroids, codebooks and the celled corpus as Parquet, one folder per cell.

    ``celled`` holds ``embedding``, or ``codes`` with codebooks. A cell is written
    by as many tasks as it has files' worth of rows, so a large cell is neither
    one task nor one file.
    """
    spark = celled.sparkSession
    rows = [(*key, -1, i, list(map(float, v))) for key, block in centroids.items() for i, v in enumerate(block)]
    for key, books in (codebooks or {}).items():
        rows += [(*key, piece, i, list(map(float, v))) for piece, book in enumerate(books) for i, v in enumerate(book)]
    schema = "dataset string, lang string, piece int, i int, vector array<double>"
    spark.createDataFrame(rows, schema).write.parquet(os.path.join(path, "vectors"))
    payload = [c for c in ("embedding", "codes") if c in celled.columns]
    celled = celled.select(*KEYS, "cell", "document_id", *payload)
    sizes = celled.groupBy(*KEYS, "cell").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_files"))
    part = F.pmod(F.xxhash64("document_id"), F.col("_files"))
    (
        celled.join(F.broadcast(sizes), [*KEYS, "cell"])  # one row per cell
        .withColumn("_part", part)
        .repartition(*KEYS, "cell", "_part")
        .drop("_files", "_part")
        .write.partitionBy(*KEYS, "cell")
        .parquet(os.path.join(path, "cells"))
    )


def load_index(spark, path: str) -> tuple[DataFrame, Matrices, dict[tuple[str, str], list[np.ndarray]]]:
    """Celled corpus, centroids and codebooks. Only the latter two, whose size is a
    parameter of the index, come to the driver."""
    stored: dict[int, Matrices] = {}
    rows = spark.read.parquet(os.path.join(path, "vectors")).orderBy(*KEYS, "piece", "i").collect()
    for row in rows:
        stored.setdefault(row["piece"], {}).setdefault((row["dataset"], row["lang"]), []).append(row["vector"])
    stored = {piece: {key: np.array(v) for key, v in blocks.items()} for piece, blocks in stored.items()}
    celled = spark.read.parquet(os.path.join(path, "cells"))
    centroids = stored.pop(-1)
    codebooks = {key: [stored[piece][key] for piece in sorted(stored)] for key in centroids} if stored else {}
    return celled.withColumns({c: F.col(c).cast("string") for c in KEYS}), centroids, codebooks


# --- product quantisation --------------------------------------------------------


def residuals(celled: DataFrame, centroids: Matrices, metric: str = "cosine") -> DataFrame:
    """``embedding`` minus the centroid of its cell."""
    shared = celled.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def rest(dataset: pa.Array, lang: pa.Array, cell: pa.Array, vectors: pa.Array) -> pa.Array:
        block = as_indexed(matrix(pa.chunked_array([vectors])), metric)
        cells = cell.to_numpy(zero_copy_only=False)
        out = np.zeros(block.shape)
        for key, at in pa.table({"a": dataset, "b": lang}).to_pandas().groupby(["a", "b"]).indices.items():
            out[at] = block[at] - shared.value[key][cells[at]]
        block = out
        offsets = np.arange(len(block) + 1, dtype=np.int32) * block.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(block.ravel()))

    return celled.withColumn("embedding", rest("dataset", "lang", "cell", "embedding"))


def train_rotation(rest: DataFrame, m: int, seed: int = 42, turns: int = lloyd.TURNS, rotate: bool = True) -> tuple[Matrices, dict]:
    """Per bundle, ``m`` codebooks of the residuals' sub-vectors and the rotation they hold for.

    A turn codes all residuals, moves each code to the mean of what it stands for and, with ``rotate``,
    takes the rotation that brings the residuals closest to what their codes say.
    """
    sample = lloyd.some_rows(rest, CODES * 8, seed)
    books, rotation = {}, {}
    for key, block in sample.items():
        if block.shape[1] % m:
            raise ValueError(f"{block.shape[1]} dimensions do not split into {m} sub-vectors")
        books[key] = [lloyd.far_seeds(piece, CODES, seed) for piece in np.split(block, m, axis=1)]
        rotation[key] = np.eye(block.shape[1])
    for _ in range(turns):
        shared = rest.sparkSession.sparkContext.broadcast((rotation, books))

        def add(key, block, held, shared=shared):
            spun, codes = block @ shared.value[0][key], shared.value[1][key]
            pieces = np.split(spun, len(codes), axis=1)
            nearest = [lloyd.add_to(held, p, piece, book) for p, (piece, book) in enumerate(zip(pieces, codes))]
            if rotate:
                said = np.hstack([book[at] for book, at in zip(codes, nearest)])
                held[len(codes)] = held.get(len(codes), 0.0) + block.T @ said

        found = lloyd.summed(rest, add)
        before, books = books, {key: [lloyd.moved(book, found[key][p]) for p, book in enumerate(codes)] for key, codes in books.items()}
        for key in rotation if rotate else ():
            u, _, v = np.linalg.svd(found[key][m])
            rotation[key] = u @ v
        if not rotate and all(np.allclose(a, b, rtol=0, atol=1e-9) for key in books for a, b in zip(books[key], before[key])):
            break
    return rotation, books


def train_codebooks(rest: DataFrame, m: int, seed: int = 42) -> dict[tuple[str, str], list[np.ndarray]]:
    """``m`` codebooks per bundle, fitted on all residuals, of all bundles and sub-vectors together."""
    return train_rotation(rest, m, seed, rotate=False)[1]


def with_codes(rest: DataFrame, codebooks: dict) -> DataFrame:
    """Residuals replaced by one code per sub-vector."""
    shared = rest.sparkSession.sparkContext.broadcast(codebooks)

    @F.arrow_udf(INTS)
    def encode(dataset: pa.Array, lang: pa.Array, vectors: pa.Array) -> pa.Array:
        def codes(key, block):
            books = shared.value[key]
            pieces = zip(np.split(block, len(books), axis=1), books)
            return np.stack([inner_or_distance(piece, book, "l2").argmin(1) for piece, book in pieces], axis=1)

        return _per_bundle(dataset, lang, vectors, codes)

    return rest.withColumn("codes", encode("dataset", "lang", "embedding")).drop("embedding")


def build_codes(
    corpus: DataFrame, nlist: int = 100, m: int = 8, metric: str = "cosine", seed: int = 42
) -> tuple[DataFrame, Matrices, dict]:
    """Coded corpus, centroids and codebooks."""
    centroids = train_cells(corpus, nlist, metric, seed)
    rest = stored(residuals(with_cell(corpus, centroids, metric), centroids, metric), "residuals")
    codebooks = train_codebooks(rest, m, seed)
    return with_codes(rest, codebooks), centroids, codebooks


def ivfpq_topk(
    queries: DataFrame,
    coded: DataFrame,
    centroids: Matrices,
    codebooks: dict,
    k: int,
    nprobe: int = 10,
    metric: str = "cosine",
    **physical,
) -> DataFrame:
    """Search over codes: scores are sums of table lookups, not exact products."""
    context = queries.sparkSession.sparkContext
    return topk(
        probes(queries, centroids, nprobe, metric),
        coded,
        k,
        ProductCodes(metric, context.broadcast(centroids), context.broadcast(codebooks)),
        keys=[*KEYS, "cell"],
        ascending=metric == "l2",
        **physical,
    )


# --- hashing ---------------------------------------------------------------------


def random_planes(tables: int, bits: int, dim: int, seed: int) -> np.ndarray:
    """Normals of ``bits`` planes for each table.

    In few dimensions planes drawn independently of each other cut alike and leave buckets uneven; there (more
    than the root of ``dim`` planes) those of a table are put at right angles, in runs of ``dim``. In
    many dimensions they nearly are.
    """
    drawn = np.random.default_rng(seed).normal(size=(tables, bits, dim))
    if bits * bits <= dim:
        return drawn
    runs = [np.linalg.qr(drawn[:, lo : lo + dim].transpose(0, 2, 1))[0].transpose(0, 2, 1) for lo in range(0, bits, max(dim, 1))]
    return np.concatenate(runs, axis=1)


def centers(corpus: DataFrame, metric: str) -> Matrices:
    """Mean vector of each bundle: where its planes go through, so that each halves it."""
    mean = Summarizer.mean(array_to_vector("embedding")).alias("mean")
    return {(r["dataset"], r["lang"]): r["mean"].toArray() for r in prepared(corpus, metric).groupBy(*KEYS).agg(mean).collect()}


def with_buckets(rows: DataFrame, planes: np.ndarray, center: Matrices, metric: str, flips: int, name: str) -> DataFrame:
    """``rows`` with ``name``: per table the vector's bucket, and then those across its
    ``flips`` nearest planes. Empty for a bundle without center."""
    shared = rows.sparkSession.sparkContext.broadcast((planes, center))

    @F.arrow_udf(INTS)
    def hashed(dataset: pa.Array, lang: pa.Array, vectors: pa.Array) -> pa.Array:
        normals, means = shared.value
        tables, bits, dim = normals.shape

        def buckets(key, block):
            if key not in means:
                return np.zeros((len(block), 0), np.int32)
            side = (as_indexed(block, metric) - means[key]) @ normals.reshape(-1, dim).T
            side = side.reshape(len(block), tables, bits)
            own = ((side > 0) << np.arange(bits)).sum(axis=2)
            near = np.argsort(np.abs(side), axis=2, kind="stable")[:, :, :flips]
            return np.concatenate([own[:, :, None], own[:, :, None] ^ (1 << near)], axis=2).reshape(len(block), -1)

        return _per_bundle(dataset, lang, vectors, buckets)

    return rows.withColumn(name, hashed.asNondeterministic()("dataset", "lang", "embedding"))


class FirstTable(Dense):
    """Exact scores under a table and bucket, of the pairs that no earlier table brings together."""

    query_columns, doc_columns = ["embedding", "probed"], ["embedding", "codes"]

    def __init__(self, metric: str, tables: int):
        super().__init__(metric)
        self.tables = tables

    def queries(self, table, key):
        probed = matrix(table["probed"]).astype(np.int32).reshape(table.num_rows, self.tables, -1)
        return super().queries(table, key), probed, key[-2]

    def docs(self, table, key):
        return super().queries(table, key), matrix(table["codes"]).astype(np.int32)

    def query_powers(self, q):
        return super().query_powers(q[0])

    doc_powers = query_powers

    def score(self, q, start, stop, d):
        vectors, probed, current = q
        out = super().score(vectors, start, stop, d[0])
        for earlier in range(current):
            met = np.zeros(out.shape, bool)
            for probe in range(probed.shape[2]):
                met |= probed[start:stop, earlier, probe][:, None] == d[1][None, :, earlier]
            out[met] = np.inf if self.metric == "l2" else -np.inf
        return out

    def likely(self, q, start, stop, d, floor, k):
        vectors, probed, current = q
        near = super().likely(vectors, start, stop, d[0], floor, k)
        if near is None:
            return None
        row, col = near
        if current:
            met = (probed[row + start, :current] == d[1][col, :current, None]).any(axis=(1, 2))
            row, col = row[~met], col[~met]
        return row, col

    def pairs(self, q, row, d, col):
        return super().pairs(q[0], row, d[0], col)


def bucketed(queries: DataFrame, corpus: DataFrame, planes: np.ndarray, center: Matrices, metric: str, flips: int) -> tuple[DataFrame, DataFrame]:
    """Queries with a row per table and probed bucket, documents with one per table."""
    each = F.col("at") % (flips + 1)
    probed = with_buckets(queries, planes, center, metric, flips, "probed")
    asked = probed.select("*", F.posexplode("probed").alias("at", "bucket"))
    asked = asked.withColumn("tbl", ((F.col("at") - each) / (flips + 1)).cast("int")).drop("at")
    held = with_buckets(corpus, planes, center, metric, 0, "codes")
    return asked, held.select("*", F.posexplode("codes").alias("tbl", "bucket"))


def lsh_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "cosine",
    tables: int = 8,
    bits: int = 4,
    flips: int = 2,
    seed: int = 42,
    planes: np.ndarray | None = None,
    center: Matrices | None = None,
    **physical,
) -> DataFrame:
    """Approximate neighbours without a trained index: exact scores for documents
    that share a hash bucket with the query in at least one table.

    A table cuts the space by ``bits`` random planes through the mean of the corpus, so a bucket
    holds about one in 2^bits of it, whatever the scale of the vectors; a query looks
    into its own bucket and across its ``flips`` nearest planes. A pair is scored in
    the first table it meets in. The bucket is a key of the top-k operator, so a large one
    is split into blocks and each block emits its best k.
    """
    if planes is None:
        dim = corpus.agg(F.max(F.size("embedding"))).first()[0] or 0
        planes = random_planes(tables, bits, dim, seed)
    center = centers(corpus, metric) if center is None else center
    asked, held = bucketed(queries, corpus, planes, center, metric, flips)
    return topk(
        asked, held, k, FirstTable(metric, len(planes)), keys=[*KEYS, "tbl", "bucket"], ascending=metric == "l2", **physical
    )


def scored_share(asked: DataFrame, held: DataFrame) -> DataFrame:
    """Per bundle: pairs that meet in the buckets, repeats included, of all pairs."""
    on = [*KEYS, "tbl", "bucket"]
    pairs = asked.groupBy(*on).count().join(held.groupBy(*on).agg(F.count(F.lit(1)).alias("docs")), on)
    met = pairs.groupBy(*KEYS).agg(F.sum(F.col("count") * F.col("docs")).alias("met"))
    distinct = lambda rows, c, name: rows.filter("tbl = 0").groupBy(*KEYS).agg(F.count_distinct(c).alias(name))
    both = met.join(distinct(asked, "query_id", "queries"), KEYS).join(distinct(held, "document_id", "documents"), KEYS)
    return both.withColumn("share", F.col("met") / (F.col("queries") * F.col("documents")))
