"""Resampling documents towards a target distribution, by bit-sliced sums of feature gains.

Features of a text are all runs of 1 to 3 consecutive words (``alnum.words``), counted in
buckets: the CRC-32 of a feature modulo ``BUCKETS``. A bucket's gain compares its share among
the target's features with that among all documents'; a document's weight is the sum
of the gains of its features.

Bit slices: a document's bucket counts become planes of one bit per bucket, plane j
holding bit j of every count. The gains are cut in the same way, positive and negative
ones apart. Ones in the AND of a count plane j and a gain plane i stand for 2^(i+j)
each, so popcounts times powers of two add up to the exact weight. A long or repetitive text
has more planes, not wider ones.

Documents of at least ``MIN_WORDS`` words take part in the draw: the highest sums of weight and
Gumbel noise, which a hash of the id decides, are drawn (a sample without replacement by
weight). Only rows above a safe lower bound of the last drawn score are ordered, by ranges;
their ranks follow from the sizes of the ranges. Bucket totals, 2 numbers per bucket, are
what the driver sees.

Null and empty texts have no feature and weight 0. Repeated rows each have their own rank,
also where id and score are equal. A null id is hashed as an empty one and comes last among
equal scores. An empty target has only empty buckets; an empty table gives an empty
result. Columns other than id and text take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from negsift.llm.alnum import texts, words
from negsift.session import stored

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
_CHUNK = 1 << 16  # words hashed at once


def bucket_counts(found: list[bytes], buckets: int) -> np.ndarray:
    """How many runs of 1, 2 and 3 words fall into each bucket."""
    total = np.zeros(buckets, np.int64)
    for at in range(0, len(found), _CHUNK):
        own = found[at : at + _CHUNK + 2]  # a run may go on into the next chunk
        spaced = [b" " + w for w in own]
        n = min(_CHUNK, len(own))
        ones = list(map(crc32, own[:n]))
        twos = list(map(crc32, spaced[1 : n + 1], ones))
        threes = list(map(crc32, spaced[2 : n + 2], twos))
        for hashes in (ones, twos, threes):
            total += np.bincount(np.array(hashes, np.int64) % buckets, minlength=buckets)
    return total


def features(n_words: int) -> int:
    return sum(max(n_words - k, 0) for k in range(3))


def totals(rows: DataFrame, text_col="text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all ``rows``; tasks add up their own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, some in texts(batches):
            for text in some:
                total += bucket_counts(words(text), buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = rows.select(F.col(text_col)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # at most a row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln ratio)`` of each bucket's smoothed shares in target and source."""
    many, s, t = len(source), source.tolist(), target.tolist()
    all_s, all_t = sum(s) + many, sum(t) + many
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)], np.int64)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Bits of some numbers >= 0 as rows of 64-bit words: row j holds bit j of each."""
    many = int(numbers.max(initial=0)).bit_length()
    bits = (numbers[None, :] >> np.arange(many)[:, None] & 1).astype(np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view("<u8")


class Gains:
    """Planes of positive gains, then of negative ones, each with its power of two and sign."""

    def __init__(self, of: np.ndarray):
        up, down = planes(np.maximum(of, 0)), planes(np.maximum(-of, 0))
        self.planes = np.concatenate([up, down])
        self.values = np.concatenate([1 << np.arange(len(up)), -(1 << np.arange(len(down)))]).astype(np.int64)

    def weight(self, counts: np.ndarray) -> int:
        """The exact sum of counts times gains."""
        total = 0
        for j, plane in enumerate(planes(counts)):
            ones = np.bitwise_count(self.planes & plane).sum(axis=1, dtype=np.int64)
            total += int(ones @ self.values) << j
        return total


def weights(docs: DataFrame, of: np.ndarray, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row."""
    buckets = len(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = Gains(of)
        for held, some in texts(batches):
            found = [words(text) for text in some]
            sums = [sliced.weight(bucket_counts(w, buckets)) if w else 0 for w in found]
            columns = [[len(w) for w in found], [features(len(w)) for w in found], sums]
            yield pa.RecordBatch.from_arrays([held.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "n_words", "n_features", "weight"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, score: str, order: list) -> DataFrame:
    """``rows`` with a gapless ``rank`` from 1 by ``order``: sorted by ranges, numbered from their sizes."""
    # The number holds the range in its upper bits and the row's place in the range in its lower 33.
    placed = stored(rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range.
    before = F.coalesce(F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("_part", before.alias("_before")))
    numbered = placed.withColumn("_part", part).join(starts, "_part").withColumn("rank", within + F.col("_before") + 1)
    return numbered.drop("_part", "_place", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, id_col="doc_id", text_col="text", target_text_col="text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row; ``rank`` is null for rows that are not drawn."""
    of = gains(totals(docs, text_col), totals(target, target_text_col))
    hashed = F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    chance = (F.conv(hashed, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(chance))).cast("long")
    rows = weights(docs, of, id_col, text_col).withColumn("score", F.col("weight") + noise)
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "weighted")

    takes_part = F.col("n_words") >= MIN_WORDS
    # The approximate percentile's own error is below 1 in 10,000 of the rows.
    low = rows.filter(takes_part).agg(F.count(F.lit(1)), F.percentile_approx("score", max(0.0, 1 - percent / 100 - 0.002), 10_000)).first()
    drawn = percent * low[0] // 100
    bound = low[1]
    if drawn and rows.filter(takes_part & (F.col("score") > bound)).count() < drawn:
        bound = None  # ties, or few rows: all of them are ordered
    above = takes_part & (F.lit(True) if bound is None else F.col("score") > bound)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    first = ranked(rows.filter(above), "score", order) if drawn else rows.filter(above).withColumn("rank", F.lit(None).cast("long"))
    first = first.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = rows.filter(~above).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).drop("_row")
