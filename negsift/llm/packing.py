"""Best-fit decreasing packing of token pieces into sequences of one size.

What best-fit decreasing does depends on the lengths alone, so it runs over
``how many pieces have length L`` for L = 1 .. size: a table of at most ``size`` rows,
whatever the corpus. Open sequences are held per remaining capacity; a segment tree
over the capacities finds the tightest one that fits in logarithmic time, and all
equal pieces that go into equally filled sequences are placed at once. The result is
that of placing piece by piece over the whole corpus. The pieces then find their place
by length and number: nothing is packed per partition.

Empty tables give empty results. Null texts count as empty and get the end token
alone. Repeated rows and repeated ids are packed each on their own. Columns other
than the id and the text take no part.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from negsift.llm.tokens import encoder
from negsift.session import stored

SIZE = 1024
END = 2


class Capacities:
    """Counts of open sequences by remaining capacity, as a segment tree of maxima of "any open"."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = bytearray(2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        at = self.leaves + capacity
        self.any[at] = is_open
        while at > 1:
            at >>= 1
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def tightest(self, needed: int) -> int | None:
        """The smallest open capacity that is at least ``needed``."""
        at = self.leaves + needed
        if self.any[at]:
            return needed
        while at > 1:
            if not at & 1 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where the pieces of each length go: ``(length, first number, first sequence, offset, each)``.

    Pieces of one length are numbered from 0. From its first number to the next
    segment's, a segment fills consecutive sequences from ``offset`` on, with ``each``
    pieces: while a sequence just used still fits one more, it is the tightest.
    Also returns how many sequences there are.
    """
    tree, runs, segments, opened = Capacities(size), {}, [], 0

    def put(capacity: int, first: int, many: int) -> None:
        if capacity and many:
            runs.setdefault(capacity, deque()).append((first, many))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        number, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = size
                first, many = opened, -(-left // (size // length))
                opened += many
            else:
                first, many = runs[capacity].popleft()
                if not runs[capacity]:
                    tree.set(capacity, False)
            each = min(capacity // length, left)
            used = min(many, left // each)
            segments.append((length, number, first, size - capacity, each))
            put(capacity - each * length, first, used)
            put(capacity, first + used, many - used)
            number, left = number + used * each, left - used * each
    return segments, opened


def cut(total: int, size: int) -> list[tuple[int, int]]:
    """Starts and lengths of a document's pieces; only the first may be shorter."""
    head = total % size or size
    return [(0, head), *((at, size) for at in range(head, total, size))]


def pieces(docs: DataFrame, id_col="doc_id", text_col="text", size=SIZE, end=END, paths=None, keep_ids=True) -> DataFrame:
    """Pieces of the encoded documents: ``doc_id, piece, start, length, ids_crc32, part, number``.

    ``part`` and ``number`` count pieces of one length within one task. ``ids`` hold the
    tokens if ``keep_ids``; :func:`pack` then takes ``ids_crc32`` from the placed ids.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, number long"
    schema += ", ids array<int>" if keep_ids else ""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = encoder(paths), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                held = batch.slice(at, 500)
                row, piece, start, length, crc, number, ids = [], [], [], [], [], [], []
                for i, text in enumerate(held.column(1).to_pylist()):
                    tokens = np.append(coder.ids(text or ""), end).astype("<u4")
                    for n, (a, many) in enumerate(cut(len(tokens), size)):
                        own = tokens[a : a + many]
                        row.append(i)
                        piece.append(n)
                        start.append(a)
                        length.append(many)
                        crc.append(0 if keep_ids else zlib.crc32(own.tobytes()))
                        number.append(seen[many])
                        seen[many] += 1
                        if keep_ids:
                            ids.append(own)
                columns = [
                    held.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(np.full(len(row), part), pa.int32()), pa.array(number, pa.int64()),
                ]
                if keep_ids:
                    ends = np.cumsum([0, *length]).astype(np.int32)
                    flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(encode, schema)


def pack(docs: DataFrame, id_col="doc_id", text_col="text", size=SIZE, end=END, paths=None, keep_ids=True) -> DataFrame:
    """Every document in sequences of ``size`` tokens: :func:`pieces` with ``sequence_id, offset``.

    Texts are encoded once, where they lie. Only counts by length, and the offset of each
    task's pieces within them, are gathered; the driver sees at most ``size`` counts.
    """
    spark = docs.sparkSession
    cuts = stored(pieces(docs, id_col, text_col, size, end, paths, keep_ids), "pieces")
    by_part = cuts.groupBy("length", "part").agg((F.max("number") + 1).alias("many"))
    by_part = stored(by_part, "piece-counts")
    counts = {r["length"]: r["many"] for r in by_part.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    segments, _ = best_fit_decreasing(counts, size)
    table = np.array(segments, np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast({int(k): table[table[:, 0] == k] for k in counts})

    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = by_part.select("length", "part", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("before"))
    ranked = cuts.join(before, ["length", "part"]).withColumn("number", F.col("number") + F.col("before"))
    columns = [c for c in cuts.columns if c not in ("part", "number")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                at, own = np.nonzero(length == k)[0], plan.value[int(k)]
                of = np.searchsorted(own[:, 1], number[at], side="right") - 1
                nth = number[at] - own[of, 1]
                sequence[at] = own[of, 2] + nth // own[of, 4]
                offset[at] = own[of, 3] + nth % own[of, 4] * k
            own = {c: batch[c] for c in columns}
            if keep_ids:
                own["ids_crc32"] = pa.array([zlib.crc32(ids.values.to_numpy().astype("<u4").tobytes()) for ids in batch["ids"]], pa.int64())
            arrays = [*own.values(), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "sequence_id", "offset"])

    fields = ", ".join(f"{c} {t}" for c, t in cuts.select(*columns).dtypes)
    return ranked.select(*columns, "number").mapInArrow(place, f"{fields}, sequence_id long, offset long")
