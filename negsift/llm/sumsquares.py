"""Online packing of token sequences by the sum-of-squares rule.

Documents go into windows of ``size`` tokens as they come. An array counts the open windows of
each fill level; a document goes to the level (or into a new window) that makes the sum of
the squared counts smallest, ties to the fullest. Counts that stay small and even leave
for any coming length a level it completes. Only documents longer than a window are cut: into
whole windows, and a rest that is placed like any other.

Each task packs the documents of its partition while it encodes them: nothing is shuffled, and
a task that is run again gives the same rows. What a task holds is its open
windows. When these reach ``max_open`` tokens, and at the end, they are settled: those filled to a power
of two need no padding and stay as they are, the tokens of all others are laid end to end and
cut into full windows, and the last of them into powers of two. So there is no padding, and documents are
cut only there, about one per settled window.

Null texts count as empty and hold the end token alone. Repeated rows and repeated ids are
packed each on their own. An empty table gives an empty result. Columns other than the id
and the text take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from negsift.llm.tokens import encoder

SIZE = 2048
END = 1
MAX_OPEN = 1 << 22
_OUT = 1 << 20  # tokens that leave a task at once


class Levels:
    """Open windows by fill level, and where the next document goes."""

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, np.int64)  # of open windows: none at 0 and at size
        self.windows: list[list] = [[] for _ in range(size)]

    def level_for(self, length: int) -> int:
        """The level that a document of ``length`` tokens goes to; 0 is a new window."""
        if length == self.size:
            return 0
        n, last = self.counts, self.size - length
        # From level h to h + length: N(h) loses one, N(h + length) gains one; a full window leaves the array.
        change = 2 * (n[length + 1 :] - n[1 : last + 1]) + 2
        change[-1] -= 1
        change[n[1 : last + 1] == 0] = np.iinfo(np.int64).max
        best = last - int(np.argmin(change[::-1]))
        return best if change[best - 1] <= 2 * n[length] + 1 else 0

    def take(self, level: int):
        """A window of this level, which is open no more."""
        self.counts[level] -= 1
        return self.windows[level].pop()

    def put(self, level: int, window) -> None:
        self.counts[level] += 1
        self.windows[level].append(window)


class Packer:
    """Packs pieces ``(document, start, ids)``; :attr:`done` has whole sequences of them."""

    def __init__(self, size: int, max_open: int):
        self.size, self.max_open = size, max_open
        self.levels, self.open_tokens = Levels(size), 0
        self.done: list[list[tuple]] = []

    def add(self, document, ids: np.ndarray) -> None:
        whole = len(ids) // self.size * self.size
        for at in range(0, whole, self.size):
            self.done.append([(document, at, ids[at : at + self.size])])
        if whole == len(ids):
            return
        piece = (document, whole, ids[whole:].copy())
        length = len(piece[2])
        level = self.levels.level_for(length)
        window = self.levels.take(level) if level else []
        window.append(piece)
        if level + length == self.size:
            self.done.append(window)
            self.open_tokens -= level
        else:
            self.levels.put(level + length, window)
            self.open_tokens += length
        if self.open_tokens >= self.max_open:
            self.settle()

    def settle(self) -> None:
        """Close all open windows without padding."""
        loose, held = [], 0
        for level, windows in enumerate(self.levels.windows):
            if level & (level - 1) == 0:
                self.done += windows
            else:
                loose += [piece for window in windows for piece in window]
                held += level * len(windows)
        self.levels, self.open_tokens = Levels(self.size), 0
        sizes = [self.size] * (held // self.size)
        sizes += [1 << b for b in range(self.size.bit_length(), -1, -1) if held % self.size >> b & 1]
        pieces = iter(loose)
        document, start, ids = next(pieces, (None, 0, ()))
        for room in sizes:
            sequence = []
            while room:
                own = ids[:room]
                sequence.append((document, start, own))
                start, ids, room = start + len(own), ids[len(own) :], room - len(own)
                if not len(ids):
                    document, start, ids = next(pieces, (None, 0, ()))
            self.done.append(sequence)


def pack(docs: DataFrame, id_col="doc_id", text_col="text", size=SIZE, end=END, max_open=MAX_OPEN, paths=None) -> DataFrame:
    """Every document in sequences of at most ``size`` tokens.

    A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer, last = encoder(paths), Packer(size, max_open), np.array([end], "<u4")
        sequence, id_type = TaskContext.get().partitionId() << 33, None

        def out() -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list] = [[] for _ in names]
            for pieces in packer.done:
                offset = 0
                for (doc_id, tokens), start, ids in pieces:
                    row = (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), tokens, sequence, offset, ids)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += len(ids)
                sequence += 1
            packer.done = []
            ends = np.cumsum([0, *columns[2]]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, "<u4"), *columns[7]]).astype(np.int32)
            arrays = [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:7]]]
            return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=names)

        waiting = 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 500):
                held = batch.slice(at, 500)
                for doc_id, text in zip(held.column(0).to_pylist(), held.column(1).to_pylist()):
                    ids = np.concatenate([coder.ids(text or ""), last])
                    packer.add((doc_id, len(ids)), ids)
                    waiting += len(ids)
                    if waiting >= _OUT:
                        yield out()
                        waiting = 0
        if id_type is not None:
            packer.settle()
            yield out()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
