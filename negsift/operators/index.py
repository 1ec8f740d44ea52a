"""Saved indexes: built once, added to, and read only where a search looks.

An index is a folder:

``vectors``    centroids, codebooks or codec, as rows of numbers
``segments``   the documents, ``segment=<name>/dataset/lang/cell``: a folder per cell of each segment
``manifest``   a row per bundle and segment: what it holds, and how far its documents are from their cells

A segment counts once its manifest rows are written, which is last, so a writer that fails
leaves nothing that is read. New documents go to the cells there are; :func:`index_report` tells how much farther they lie
from them than the first ones, which says when to build anew. A search finds the cells it needs first
(at most one name per centroid comes to the driver) and then reads the folders of these cells only.

``ivf`` keeps vectors, ``ivfpq`` codes, ``plaid`` residuals of token vectors; a document of several
tokens stands in the cell of each of them.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from negsift.operators import cells, residual
from negsift.operators.balls import _distance
from negsift.operators.late import exact_scores, most_cells, shared_topk, token_probes
from negsift.operators.scorers import CentroidMaxSim, Dense, ProductCodes
from negsift.operators.topk import BROADCAST_BYTES, best, topk
from negsift.schema import KEYS
from negsift.session import stored

KINDS = ("ivf", "ivfpq", "plaid")
ROWS_PER_FILE = 200_000

_PAYLOAD = {"ivf": "embedding array<double>", "ivfpq": "codes array<int>", "plaid": "codes array<int>, packed binary"}
_MANIFEST = "segment string, at timestamp, dataset string, lang string, kind string, metric string, bits int, documents long, mean_far double"
#: What rows of ``vectors`` are: centroids, codec cutoffs, codec middles; from 0 on, codebooks.
_CENTROIDS, _CUTOFFS, _MIDDLES = -1, -2, -3


class Saved:
    """An index as read from its folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.manifest = spark.read.schema(_MANIFEST).parquet(os.path.join(path, "manifest"))
        first = self.manifest.orderBy("at").first()
        self.kind, self.metric, self.bits = first["kind"], first["metric"], first["bits"]
        by: dict[int, dict] = {}
        for row in spark.read.parquet(os.path.join(path, "vectors")).orderBy(*KEYS, "piece", "i").toLocalIterator():
            by.setdefault(row["piece"], {}).setdefault((row["dataset"], row["lang"]), []).append(row["vector"])
        vectors = {piece: {key: np.array(v) for key, v in blocks.items()} for piece, blocks in by.items()}
        self.centroids = vectors[_CENTROIDS]
        self.codebooks = {key: [vectors[p][key] for p in sorted(vectors) if p >= 0] for key in self.centroids}
        self.codec = residual.Codec(self.bits, self.centroids, vectors.get(_CUTOFFS, {}), vectors.get(_MIDDLES, {}))

    def segments(self) -> list[str]:
        return sorted(r["segment"] for r in self.manifest.select("segment").distinct().collect())

    def documents(self, asked: DataFrame | None = None) -> DataFrame:
        """The documents of all segments, or of the cells that ``asked`` names: no other folder is read."""
        schema = f"document_id string, {_PAYLOAD[self.kind]}, segment string, dataset string, lang string, cell int"
        root = os.path.join(self.path, "segments")
        reader = self.spark.read.schema(schema).option("basePath", root)
        rows = reader.parquet(*[os.path.join(root, f"segment={name}") for name in self.segments()])
        return rows if asked is None else rows.filter(cells_asked(asked))


def _by_bundle(asked: DataFrame) -> list[tuple[Column, list[int]]]:
    """The cells of some queries, bundle by bundle, with the condition that a row is of the bundle."""
    by: dict[tuple, list] = {}
    for r in asked.select(*KEYS, "cell").distinct().collect():
        by.setdefault((r["dataset"], r["lang"]), []).append(r["cell"])
    return [((F.col("dataset") == dataset) & (F.col("lang") == lang), sorted(wanted)) for (dataset, lang), wanted in sorted(by.items())]


def cells_asked(asked: DataFrame) -> Column:
    """A condition on the partition columns: the cells of some queries, bundle by bundle."""
    found = F.lit(False)
    for bundle, wanted in _by_bundle(asked):
        found = found | (bundle & F.col("cell").isin(wanted))
    return found


def own_cells(asked: DataFrame) -> Column:
    """Those of a document's centroids that some queries ask for."""
    found = F.array().cast("array<int>")
    for bundle, wanted in _by_bundle(asked):
        found = F.when(bundle, F.array_intersect("codes", F.lit(wanted).cast("array<int>"))).otherwise(found)
    return found


def _write_segment(rows: DataFrame, path: str, kind: str, metric: str, bits: int) -> None:
    """``rows`` with ``cell, far`` and the payload; a large cell is several tasks and files."""
    name = uuid.uuid4().hex
    rows = stored(rows, "segment")
    on = [*KEYS, "cell"]
    sizes = F.broadcast(rows.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).cast("int").alias("_files")))  # a row per cell
    payload = [c.split()[0] for c in _PAYLOAD[kind].split(", ")]
    part = F.pmod(F.xxhash64("document_id"), F.col("_files"))
    spread = rows.join(sizes, on).withColumn("_part", part).repartition(*on, "_part").select(*on, "document_id", *payload)
    spread.write.partitionBy(*on).parquet(os.path.join(path, "segments", f"segment={name}"))
    told = rows.groupBy(*KEYS).agg(F.count_distinct("document_id").alias("documents"), F.avg("far").alias("mean_far"))
    fixed = {"segment": F.lit(name), "at": F.current_timestamp(), "kind": F.lit(kind), "metric": F.lit(metric), "bits": F.lit(bits)}
    told = told.withColumns(fixed).select(*[c.split()[0] for c in _MANIFEST.split(", ")])
    told.coalesce(1).write.mode("append").parquet(os.path.join(path, "manifest"))


def _celled(corpus: DataFrame, kind: str, metric: str, centroids, codebooks, codec) -> DataFrame:
    """Documents with the payload of their kind, their cells, and their distance from them."""
    if kind == "plaid":
        documents = residual.compress(corpus, codec, far=True).documents
        return documents.withColumn("cell", F.explode(F.array_distinct("codes")))
    celled = cells.with_cell(corpus.select(*KEYS, "document_id", "embedding"), centroids, metric)
    celled = celled.withColumn("far", _distance(celled, centroids, metric)[0])
    if kind == "ivf":
        return celled.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return cells.with_codes(cells.residuals(celled, centroids, metric), codebooks)


def build_index(
    corpus: DataFrame, path: str, kind: str = "ivf", metric: str = "cosine", nlist: int = 100, m: int = 8, bits: int = 2, seed: int = 42
) -> None:
    """Train on ``corpus`` and write it as the first segment of a new index."""
    if kind not in KINDS:
        raise ValueError(f"unknown index kind: {kind}")
    spark, codebooks, codec = corpus.sparkSession, {}, None
    if kind == "plaid":
        metric, codec = "ip", residual.train_codec(corpus, nlist, bits, seed)
        centroids = codec.centroids
    else:
        centroids = cells.train_cells(corpus, nlist, metric, seed)
        if kind == "ivfpq":
            rest = stored(cells.residuals(cells.with_cell(corpus, centroids, metric), centroids, metric), "residuals")
            codebooks = cells.train_codebooks(rest, m, seed)
    blocks = [(_CENTROIDS, centroids)]
    if codec:
        blocks += [(_CUTOFFS, codec.cutoffs), (_MIDDLES, codec.middles)]
    for piece in range(m if codebooks else 0):
        blocks.append((piece, {key: books[piece] for key, books in codebooks.items()}))
    rows = [(*key, piece, i, list(map(float, v))) for piece, block in blocks for key, vectors in block.items() for i, v in enumerate(vectors)]
    schema = "dataset string, lang string, piece int, i int, vector array<double>"
    spark.createDataFrame(rows, schema).write.parquet(os.path.join(path, "vectors"))
    _write_segment(_celled(corpus, kind, metric, centroids, codebooks, codec), path, kind, metric, bits)


def append_index(corpus: DataFrame, path: str) -> int:
    """Add documents in a segment of their own; ids that the index holds stay as they are. Returns how many were added."""
    index = Saved(corpus.sparkSession, path)
    held = index.documents().select(*KEYS, "document_id").distinct()
    known = corpus.sparkSession.createDataFrame(sorted(index.centroids), "dataset string, lang string")  # bundles without cells are left out
    new = stored(corpus.join(held, [*KEYS, "document_id"], "left_anti").join(F.broadcast(known), KEYS, "left_semi"), "appended")
    many = new.count()
    if many:
        _write_segment(_celled(new, index.kind, index.metric, index.centroids, index.codebooks, index.codec), path, index.kind, index.metric, index.bits)
    return many


def index_report(spark: SparkSession, path: str) -> DataFrame:
    """Per bundle and segment: documents, mean distance to their cells, and ``drift``, that over the first segment's."""
    rows = Saved(spark, path).manifest
    first = rows.groupBy(*KEYS).agg(F.min_by("mean_far", F.struct("at", "segment")).alias("_first"))
    drift = F.when(F.col("_first") > 0, F.col("mean_far") / F.col("_first")).otherwise(F.lit(1.0))
    return rows.join(first, KEYS).withColumn("drift", drift).select("segment", "at", *KEYS, "documents", "mean_far", "drift")


def search_index(queries: DataFrame, path: str, k: int, nprobe: int = 10, keep: int | None = None, **physical) -> DataFrame:
    """Hits from a saved index: of vectors exact inside the probed cells, of codes and residuals as read back."""
    spark = queries.sparkSession
    index = Saved(spark, path)
    context, ascending = spark.sparkContext, index.metric == "l2"
    keys = [*KEYS, "cell"]
    if index.kind != "plaid":
        asked = stored(cells.probes(queries.select(*KEYS, "query_id", "embedding"), index.centroids, nprobe, index.metric), "probes")
        found = index.documents(asked)
        scorer = Dense(index.metric)
        if index.kind == "ivfpq":
            scorer = ProductCodes(index.metric, context.broadcast(index.centroids), context.broadcast(index.codebooks))
        return topk(asked, found, k, scorer, keys=keys, ascending=ascending, **physical)
    queries = queries.filter(F.size("tokens") > 0)
    asked = stored(token_probes(queries, index.centroids, nprobe), "probes")
    found = index.documents(asked).withColumn("cells", own_cells(asked))
    scorer = CentroidMaxSim(context.broadcast(index.centroids))
    hits = shared_topk(asked, found, keep or max(4 * k, 256), scorer, most_cells(index.centroids), **physical)
    candidates = stored(hits.select(*KEYS, "query_id", "document_id"), "candidates")
    # A document stands in several cells; it is read again from the smallest that was asked for.
    mine = found.join(candidates.select(*KEYS, "document_id").distinct(), [*KEYS, "document_id"], "left_semi")
    least = mine.groupBy(*KEYS, "document_id").agg(F.min("cell").alias("cell"))
    whole = mine.join(least, [*KEYS, "document_id", "cell"], "left_semi")
    limit = physical.get("broadcast_bytes", BROADCAST_BYTES)
    return best(exact_scores(candidates, queries, whole, limit, residual.opened(whole, index.codec)), k)
