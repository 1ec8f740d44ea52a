"""Vector expressions and the network-free hashed encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from negsift.functions.text import TOKEN_SPLIT


def l2_normalize(vector: Column) -> Column:
    """Unit vector; a zero vector stays as it is.

    The norm is bound by an outer lambda. Written inside the inner one it would be
    computed again for each element.
    """
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    divisor = F.when(squares > 0, F.sqrt(squares)).otherwise(F.lit(1.0))
    return F.transform(F.array(divisor), lambda n: F.transform(vector, lambda x: x.cast("double") / n))[0]


#: Bytes of texts, and texts, whose words are held at once.
RUN_BYTES, RUN_TEXTS = 1 << 20, 1024


def text_runs(texts: pa.Array) -> list[tuple[int, int]]:
    """Runs of texts of about ``RUN_BYTES`` together, ``RUN_TEXTS`` at most; a run may be one long text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    out, lo = [], 0
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = min(max(int(np.searchsorted(ends, before + RUN_BYTES, side="right")), lo + 1), lo + RUN_TEXTS, len(texts))
        out.append((lo, hi))
        lo = hi
    return out


def hashed_counts(text: Column, dim: int, limit: int = 0) -> Column:
    """Dense vector of token counts per bucket, over the whole text.

    Tokens are lower-cased words; a token's bucket is the number that the first
    four hex digits of its MD5 make, modulo ``dim``. ``limit`` keeps the first
    tokens only. Each Arrow batch is split at once and hashed once per distinct
    token, which was nine times faster here than hashing every token in the JVM.
    """

    def some(texts: pa.Array) -> pa.Array:
        lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), TOKEN_SPLIT)
        words = lists.flatten()
        rows = pc.list_parent_indices(lists).to_numpy()
        real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        if limit:
            seen = np.cumsum(real) - real
            first = np.searchsorted(rows, np.arange(len(texts)))
            before = seen[np.minimum(first, max(len(seen) - 1, 0))] if len(seen) else seen
            real &= seen - before[rows] < limit
        coded = words.filter(pa.array(real)).dictionary_encode()
        hashes = np.array(
            [int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % dim for word in coded.dictionary.to_pylist()],
            dtype=np.int64,
        )
        cells = rows[real].astype(np.int64) * dim
        if len(cells):
            cells += hashes[coded.indices.to_numpy()]
        counts = np.bincount(cells, minlength=len(texts) * dim).astype(np.float32)
        offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dim)
        return pa.ListArray.from_arrays(offsets, pa.array(counts))

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def encode(texts: pa.Array) -> pa.Array:
        parts = [some(texts.slice(lo, hi - lo)) for lo, hi in text_runs(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

    return encode(text)


def token_runs(texts: pa.Array, limit: int = 0) -> Iterator[pa.Array]:
    """Token vectors of the texts, a run of them at a time: a token is far larger than its word."""
    for lo, hi in text_runs(texts):
        lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.slice(lo, hi - lo), "")), TOKEN_SPLIT)
        own = [[w for w in dict.fromkeys(words) if w][: limit or None] for words in lists.to_pylist()]
        place: dict[str, int] = {}
        at = np.array([place.setdefault(w, len(place)) for words in own for w in words], np.int64)
        digests = b"".join(hashlib.md5(w.encode()).digest() for w in place)
        vectors = np.frombuffer(digests, np.uint8).reshape(-1, 16) - 127.5
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        flat = vectors.astype(np.float32)[at].ravel()
        tokens = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * 16), pa.array(flat))
        ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), tokens)


def hashed_tokens(text: Column, limit: int = 0) -> Column:
    """A unit vector per distinct lower-cased word, in order of first occurrence.

    Its 16 numbers are the bytes of the word's MD5, less 127.5. ``limit`` keeps the first
    words only. Vectors leave a task in runs of texts. The column is marked so that a filter on it reads it, and does not
    make it once more.
    """

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.FloatType())))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from token_runs(texts, limit)

    return encode.asNondeterministic()(text)


def cut_vector(vector: Column, parts: int, width: int) -> Column:
    """A vector as ``parts`` consecutive pieces of ``width``: array of arrays."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.slice(vector, i * width + 1, F.lit(width))
    )
