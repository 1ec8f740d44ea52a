"""Words of letters, digits and everything beyond ASCII, as UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: A-Z become a-z; what is neither a letter, a digit nor beyond ASCII becomes a space.
_TABLE = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, only A-Z lower-cased. Null has none."""
    return (text or b"").translate(_TABLE).split()


def texts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Batches of at most ``rows`` rows, each with the UTF-8 of its last column."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held = batch.slice(at, rows)
            yield held, held.column(held.num_columns - 1).cast(pa.binary()).to_pylist()
