"""Keeping or leaving out rows by their source position, with the texts where they are read.

A set of positions becomes bitmaps of 32,768 positions each, built task by task and merged: 4 KB a bitmap,
so a billion documents are 125 MB. Up to ``MAP_BYTES`` of them, counted before, go to all tasks, which look a
row's bit up while they read it; no text is shuffled. Beyond that, or where positions are so far apart
that bitmaps hold little, the rows are joined by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from negsift.schema import KEYS
from negsift.session import stored

MAP_BYTES = 256 << 20
_BITMAP = 4096  # bytes: what Spark's bitmap functions make


def by_position(rows: DataFrame, positions: DataFrame, keep: bool, keys: list[str] = KEYS, map_bytes: int = MAP_BYTES) -> DataFrame:
    """The ``rows`` whose ``pos`` is among the ``positions`` of their ``keys``, or is not; a null is never."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("_bits")
    known = positions.filter("pos is not null").groupBy(*keys, F.bitmap_bucket_number("pos").alias("_bucket")).agg(bits)
    maps = stored(known, "position-maps")
    if maps.count() * _BITMAP > map_bytes:
        return rows.join(positions.select(*keys, "pos"), [*keys, "pos"], "left_semi" if keep else "left_anti")
    met = rows.withColumn("_bucket", F.bitmap_bucket_number("pos")).join(F.broadcast(maps), [*keys, "_bucket"], "left")
    at = "bitmap_bit_position(pos)"
    byte = f"cast(conv(hex(substring(_bits, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
    held = F.coalesce(F.expr(f"shiftright({byte}, cast({at} % 8 as int)) % 2 = 1"), F.lit(False))
    return met.filter(held if keep else ~held).select(*rows.columns)
