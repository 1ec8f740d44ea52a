"""Near-duplicates by 64-bit SimHash, found at the anchors of a covering code.

Fingerprint: one bit of 64 per position, set where more than half of the text's shingle
hashes have it set (XXH64, seed 42, of the space-joined shingle; repeats count). Two
texts are linked when their fingerprints differ in at most 2 bits; groups are the
connected components.

Search: two fingerprints that differ in at most 2 bits differ in at most 1 of one of
their halves. The anchors of a half are the code words of the Hamming code of length 31
(its covering radius is 1: every word is its nearest code word, or one bit away), once
for each value of the half's last bit. A fingerprint's home is its nearest anchor; it is
copied to all anchors within the covering radius plus the threshold of the half, that is
2 (about 16.5 per half). So of two linked fingerprints, each is copied to the other's
home, and comparing the homes of an anchor with its copies finds every link and no
other: there is no cap and no probability.

Equal fingerprints are one row from the start. An anchor gives one link per copy and
not one per pair, so a dense group costs its size and not its square.

Nulls and empty texts have no shingles and fingerprint zero, which links like any other.
Texts of fewer words than a shingle have one, the whole text. Repeated rows and ids stay
rows of the result; a group without any id has a null ``component_id``. Columns other
than the id and the text take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from negsift.llm.components import components
from negsift.llm.frames import fresh, row_key
from negsift.session import stored

THRESHOLD = 2
_HASHES = 1 << 16  # shingle hashes whose bits are summed at once
_PAIRS = 1 << 21  # pairs compared at once
_ROWS = 1 << 18  # rows of anchors worked on at once


def fingerprint(text: str | None, width: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(width, len(words)) - 1
    starts, ends = starts[: len(words) - span], ends[span:]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _HASHES):
        part = zip(starts[at : at + _HASHES].tolist(), ends[at : at + _HASHES].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in part], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 5) -> DataFrame:
    """``doc_id, fp`` (a signed long) of each row, by shingles of ``width`` words."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                held = batch.slice(at, 500)
                prints = [fingerprint(text, width) for text in held.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([held.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, fp long")


# --- anchors ---------------------------------------------------------------------

_PLACES = np.arange(1, 32, dtype=np.int64)


def _flips() -> np.ndarray:
    """By syndrome: what to flip in 31 bits to reach each code word at distance 1 or 2.

    First the one at distance 1, the home, then the 15 at distance 2.
    """
    out = np.zeros((32, 16), np.int64)
    for syndrome in range(1, 32):
        pairs = [(i, i ^ syndrome) for i in range(1, 32) if 0 < i ^ syndrome and i < i ^ syndrome]
        out[syndrome] = [1 << (syndrome - 1), *((1 << (i - 1)) | (1 << (j - 1)) for i, j in pairs)]
    return out


_FLIPS = _flips()


def _syndrome(coded: np.ndarray) -> np.ndarray:
    out = np.zeros(len(coded), np.int64)
    for place in _PLACES:
        out ^= ((coded >> (place - 1)) & 1) * place
    return out


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All anchors of each fingerprint: ``(row, anchor, is it the home)``."""
    rows, found, homes = [], [], []
    own = np.arange(len(prints))
    for half in (0, 1):
        word = (prints.view(np.uint64) >> np.uint64(32 * half)).astype(np.int64) & 0xFFFFFFFF
        coded, rest = word & 0x7FFFFFFF, word >> 31
        syndrome = _syndrome(coded)
        base = (half << 32) | (rest << 31)
        home = coded ^ _FLIPS[syndrome, 0]
        off = np.nonzero(syndrome)[0]
        near = (coded[off, None] ^ _FLIPS[syndrome[off], 1:]) | base[off, None]
        rows += [own, own, np.repeat(off, 15)]
        found += [home | base, home | base ^ (1 << 31), near.ravel()]
        homes += [np.ones(len(own), bool), np.zeros(len(own) + near.size, bool)]
    return np.concatenate(rows), np.concatenate(found), np.concatenate(homes)


def _spread_to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            prints = batch.column(0).slice(at, 4096).to_numpy()
            row, anchor, home = anchors(prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(prints[row]), pa.array(home)], names=["anchor", "fp", "home"]
            )


class _Forest:
    """Rows of a chunk and the smallest row each is linked to so far."""

    def __init__(self, rows: int):
        self.root = np.arange(rows)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the trees of ``a[i]`` and ``b[i]``, without regard to their order."""
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            differ = a != b
            high, low = np.maximum(a[differ], b[differ]), np.minimum(a[differ], b[differ])
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up
            a, b = high, low


def _links(anchor: np.ndarray, prints: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the linked fingerprints of whole anchors (rows sorted by anchor)."""
    starts = np.nonzero(np.diff(anchor, prepend=anchor[0] - 1))[0]
    sizes = np.diff(np.append(starts, len(anchor)))
    group = np.repeat(np.arange(len(starts)), sizes)
    at_home = np.nonzero(home & (sizes[group] > 1))[0]
    forest, unsigned = _Forest(len(anchor)), prints.view(np.uint64)
    many = sizes[group[at_home]]
    cuts = np.searchsorted(np.cumsum(many), np.arange(_PAIRS, many.sum() + _PAIRS, _PAIRS), side="right")
    for lo, hi in zip([0, *cuts[:-1]], cuts):
        hi = max(hi, lo)
        one, n = at_home[lo:hi], many[lo:hi]
        for a, b in _pairs(one, n, starts[group[one]]):
            close = np.bitwise_count(unsigned[a] ^ unsigned[b]) <= threshold
            forest.link(a[close], b[close])
    low = np.nonzero(forest.root != np.arange(len(anchor)))[0]
    return prints[low], prints[forest.root[low]]


def _pairs(rows: np.ndarray, many: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row with the ``many`` rows from ``first`` on; a long list comes in parts."""
    short = many <= _PAIRS
    if short.any():
        a = np.repeat(rows[short], many[short])
        ends = np.cumsum(many[short])
        step = np.arange(len(a)) - np.repeat(ends - many[short], many[short])
        yield a, np.repeat(first[short], many[short]) + step
    for row, n, at in zip(rows[~short], many[~short], first[~short]):
        for lo in range(at, at + n, _PAIRS):
            b = np.arange(lo, min(lo + _PAIRS, at + n))
            yield np.full(len(b), row), b


def _compare(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def found(parts):
            anchor, prints, home = (np.concatenate(x) for x in zip(*parts))
            a, b = _links(anchor, prints, home, threshold)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            home = batch.column(2).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
            if held and (cut or held[-1][0][-1] != anchor[-1]):
                held.append((anchor[:cut], prints[:cut], home[:cut]))
                rows += cut
                if rows >= _ROWS:
                    yield found(held)
                    held, rows = [], 0
                anchor, prints, home = anchor[cut:], prints[cut:], home[cut:]
            held.append((anchor, prints, home))
            rows += len(anchor)
        if held:
            yield found(held)

    return run


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints of ``prints`` (``fp``) that connect all close ones."""
    if threshold != THRESHOLD:
        raise ValueError(f"the anchors are laid out for {THRESHOLD} differing bits")
    spread = prints.mapInArrow(_spread_to_anchors, "anchor long, fp long, home boolean")
    by_anchor = spread.repartition("anchor").sortWithinPartitions("anchor")
    return by_anchor.mapInArrow(_compare(threshold), "a long, b long")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 5) -> DataFrame:
    """``doc_id, fp, component_id`` of each row; ``component_id`` is the smallest id of its group."""
    rows = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct, "distinct-fingerprints")
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # One row per fingerprint; a text with very many copies is split by the adaptive join.
    known = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(known, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 5) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest id stays.

    A null id is larger than any other; among rows of one id the smallest digest of id and text stays.
    Rows equal in both are copies, one of which stays. What is joined to the texts are
    keys of the rows that go, or that several rows share.
    """
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    # The key goes through the fingerprints in place of the id, behind it.
    both = keyed.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(key).alias("key")).alias("doc_id"), text_col)
    found = stored(near_duplicates(both, "doc_id", text_col, width).select("doc_id.key", F.col("component_id.key").alias("kept")), "groups")
    gone = found.filter("key <> kept").select(F.col("key").alias(key)).distinct()
    repeated = stored(found.filter("key = kept").groupBy(F.col("key").alias(key)).count().filter("count > 1").select(key), "repeated")
    stay = keyed.join(gone, key, "left_anti")
    once = stay.join(repeated, key, "left_anti")
    several = stay.join(repeated, key, "left_semi").dropDuplicates([key])
    return once.unionByName(several).select(*docs.columns)
