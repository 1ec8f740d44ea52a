"""How a chunk of queries and a chunk of documents become a score matrix.

A scorer names its payload columns and the rows of it that make a chunk, turns an Arrow table of either side into
arrays once per chunk, and scores a range of the queries against all documents.
All scores are in doubles. ``likely`` names the pairs that may reach a floor per query, from products in single
precision and a bound of their error, and ``pairs`` scores given pairs; a scorer can do without the two.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa

from negsift.schema import SCORE_PLACES

# The known metrics.
METRICS = ("cosine", "ip", "l2")


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    return metric


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A list column as a matrix; all lists must have one length."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lists.null_count or lengths.min() != lengths.max()):
        raise ValueError("vectors differ in their number of dimensions")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1).astype(np.float64, copy=False)


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=vectors.copy(), where=norms > 0)


def inner_or_distance(q: np.ndarray, d: np.ndarray, metric: str) -> np.ndarray:
    if q.shape[1] != d.shape[1]:
        raise ValueError("vectors differ in their number of dimensions")
    dot = q @ d.T
    if metric != "l2":
        return dot
    return np.maximum((q * q).sum(1)[:, None] + (d * d).sum(1)[None, :] - 2 * dot, 0.0)


def powers(lengths: np.ndarray) -> np.ndarray:
    """The nearest power of ten of each length; 0 for length 0."""
    out = np.zeros(len(lengths), np.int64)
    some = lengths > 0
    out[some] = np.rint(np.log10(lengths[some])).astype(np.int64)
    return out


#: Cells of one product in single precision, 1 MB.
TILE = 1 << 18
#: Cells that are worked on while they are in the cache, 128 KB in single precision.
HOT = 1 << 15
#: Numbers of each side that are copied at once to score given pairs, 2 MB.
PAIRED = 1 << 18


def error(terms: int) -> float:
    """Bound of the error of a sum of so many products in single precision, of vectors of length 1 at most."""
    return 1e-6 + 2e-7 * terms


def at_least(bound: np.ndarray) -> np.ndarray:
    """A bound in single precision that is not above the given one."""
    return (bound - 1e-6 * np.abs(bound)).astype(np.float32)


def reaching(rough: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the cells that reach ``bound``; few do, so eight are looked at together."""
    cells = rough.size
    hit = np.zeros(-(-cells // 8) * 8, bool)
    np.greater_equal(rough, bound, out=hit[:cells].reshape(rough.shape))
    some = np.flatnonzero(hit.view(np.uint64))
    at = (some[:, None] * 8 + np.arange(8)).ravel()
    return np.divmod(at[hit[at]], rough.shape[1])


def joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([row for row, _ in found]), np.concatenate([col for _, col in found])


class Vectors:
    """Vectors in doubles, and as far as it is asked for in single precision with the longest at length 1."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors

    def __len__(self):
        return len(self.vectors)

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.linalg.norm(self.vectors, axis=1)

    @cached_property
    def longest(self) -> float:
        return float(self.lengths.max(initial=0.0))

    @cached_property
    def small(self) -> np.ndarray:
        return (self.vectors / self.longest).astype(np.float32)

    @property
    def plain(self) -> bool:
        """Lengths are such that squares and quotients of them stay in range."""
        return 1e-100 < self.longest < 1e100


class Dense:
    """One vector per text: cosine, inner product or squared distance."""

    query_columns = doc_columns = ["embedding"]
    query_block, doc_block = 8_192, 20_000

    def __init__(self, metric: str):
        self.metric = check_metric(metric)

    def queries(self, table, key):
        vectors = matrix(table["embedding"])
        return Vectors(unit(vectors) if self.metric == "cosine" else vectors)

    docs = queries

    def query_powers(self, q):
        return powers(q.lengths) if self.metric != "cosine" else np.zeros(len(q), np.int64)

    doc_powers = query_powers

    def score(self, q, start, stop, d):
        return inner_or_distance(q.vectors[start:stop], d.vectors, self.metric)

    def likely(self, q, start, stop, d, floor, k):
        if not q.plain or not d.plain or q.vectors.shape[1] != d.vectors.shape[1]:
            return None
        size, ratio, less = q.longest * d.longest, 1.0, None
        bound = floor / size
        if self.metric == "l2":  # a distance is at most -floor if the product less half of the document's square reaches this
            bound, ratio = (q.lengths[start:stop] ** 2 + floor) / (2 * size), max(1.0, d.longest / q.longest)
            less = (d.lengths**2 / (2 * size)).astype(np.float32)
            if not 1e-6 < d.longest / q.longest < 1e6:
                return None
        bound = at_least(bound - error(q.vectors.shape[1]) * ratio)[:, None]
        step, found = max(1, TILE // (stop - start)), []
        for lo in range(0, len(d), step):
            rough = q.small[start:stop] @ d.small[lo : lo + step].T
            if less is not None:
                rough -= less[lo : lo + step]
            row, col = reaching(rough, bound)
            found.append((row, col + lo))
        return joined(found)

    def pairs(self, q, row, d, col):
        dot, step = np.empty(len(row)), max(1, PAIRED // max(1, q.vectors.shape[1]))
        for lo in range(0, len(row), step):
            some = slice(lo, lo + step)
            dot[some] = np.einsum("ij,ij->i", q.vectors[row[some]], d.vectors[col[some]])
        if self.metric != "l2":
            return dot
        return np.maximum(q.lengths[row] ** 2 + d.lengths[col] ** 2 - 2 * dot, 0.0)


#: Tokens of a text up to which those of all texts are taken by their place.
SLOTS = 16


class Ragged:
    """Token vectors of several texts in one matrix, and where each text starts."""

    def __init__(self, column: pa.ChunkedArray):
        texts = column.combine_chunks()
        self.counts = texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.tokens = matrix(pa.chunked_array([texts.flatten()])) if self.starts[-1] else np.zeros((0, 0))

    def powers_at(self, texts: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_powers"):
            self._powers = self.powers()
        return self._powers[texts]

    @cached_property
    def each(self) -> int:
        """Tokens of each text if all have as many, else 0."""
        counts = self.counts
        return int(counts[0]) if len(counts) and counts.min() == counts.max() and 0 < counts[0] <= SLOTS else 0

    @cached_property
    def longest(self) -> float:
        return float(np.linalg.norm(self.tokens, axis=1).max(initial=0.0))

    @cached_property
    def slots(self) -> np.ndarray:
        """(token, text, dimension) of texts that have as many tokens each."""
        return np.ascontiguousarray(self.tokens.reshape(len(self.counts), self.each, -1).transpose(1, 0, 2))

    @cached_property
    def small(self) -> np.ndarray:
        """The same in single precision, the longest at length 1."""
        return (self.slots / self.longest).astype(np.float32)

    @cached_property
    def small_tokens(self) -> np.ndarray:
        """All tokens in single precision, the longest at length 1."""
        return (self.tokens / self.longest).astype(np.float32)

    def powers(self) -> np.ndarray:
        """By the longest token of each text."""
        lengths = np.linalg.norm(self.tokens, axis=1)[None, :] if len(self.tokens) else np.zeros((1, 0))
        return powers(best_per_text(lengths, self.starts, self.counts)[0])


def best_per_text(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Maximum over each text's columns; a text without tokens adds nothing."""
    out = np.zeros((values.shape[0], len(counts)))
    full = counts > 0
    if full.any() and values.shape[0]:
        out[:, full] = np.maximum.reduceat(values, starts[:-1][full], axis=1)
    return out


def sum_per_text(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), values.shape[1]))
    full = counts > 0
    if full.any() and values.shape[1]:
        out[full] = np.add.reduceat(values, starts[:-1][full], axis=0)
    return out


def runs(starts: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Texts in runs of about ``most`` tokens; a run may be one long text."""
    texts = len(starts) - 1
    cuts = np.searchsorted(starts, np.arange(0, max(starts[-1], 1), max(most, 1)))
    cuts = np.unique(np.concatenate([[0], cuts[cuts < texts], [texts]]))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def distinct(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and the one of each row. Words repeat, so their vectors do."""
    bits = (tokens.astype(np.float64) + 0.0).view(np.uint64)
    odd = np.random.default_rng(0).integers(1, 1 << 63, bits.shape[1], dtype=np.uint64) * 2 + 1
    mixed = ((bits ^ (bits >> np.uint64(32))) * odd).sum(axis=1, dtype=np.uint64)
    _, first, own = np.unique(mixed ^ (mixed >> np.uint64(29)), return_index=True, return_inverse=True)
    if not np.array_equal(tokens[first][own], tokens):  # two rows of one hash, or no number
        return tokens, np.arange(len(tokens))
    return tokens[first], own


def best_of_places(values: np.ndarray, place: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(text, column): the maximum of the rows ``values[place]`` of each text; a text without any has zeros.

    Token by token for all texts together, the few longest to their ends at once.
    """
    out = np.zeros((len(counts), values.shape[1]), values.dtype)
    order = np.argsort(-counts, kind="stable")
    order = order[: np.count_nonzero(counts)]
    for lo in range(0, len(order), 128):
        own = order[lo : lo + 128]
        at, many = starts[own], counts[own]
        top, live, token = values[place[at]], len(own), 1
        while True:
            while live and many[live - 1] <= token:
                live -= 1
            if live < 8:
                break
            np.maximum(top[:live], values[place[at[:live] + token]], out=top[:live])
            token += 1
        for i in range(live):
            np.maximum(top[i], values[place[at[i] + token : at[i] + many[i]]].max(axis=0), out=top[i])
        out[own] = top
    return out


class MaxSim:
    """Late interaction: for each query token the best document token, summed.

    Texts of unequal length are scored by their distinct tokens. Once queries have floors, they are so in single
    precision, and only pairs that may reach the floor in doubles.
    """

    query_columns = doc_columns = ["tokens"]
    query_block, doc_block, first_block = 1_024, 2_000, 500
    cells = 8_000_000  # of query tokens times document tokens in one product
    side = 256  # distinct query tokens of one product
    products = True  # scores are made of products of the tokens themselves

    def queries(self, table, key):
        return Ragged(table["tokens"])

    docs = queries

    def query_powers(self, q):
        return q.powers()

    doc_powers = query_powers

    def similarities(self, q, d, tokens, lo, hi):
        """Query tokens against the tokens of the documents ``lo`` to ``hi``."""
        return tokens @ d.tokens[d.starts[lo] : d.starts[hi]].T

    def tokens_of(self, q, start, stop):
        return q.tokens[q.starts[start] : q.starts[stop]]

    def score(self, q, start, stop, d):
        """Queries and documents are taken in runs whose product of tokens is bounded."""
        out = np.zeros((stop - start, len(d.counts)))
        if not q.starts[stop] - q.starts[start] or not d.starts[-1]:
            return out
        if self.even(q, d):
            step = max(1, TILE // (2 * (stop - start)))
            for lo in range(0, len(d.counts), step):
                self.by_slots(q.slots[:, start:stop], d.slots[:, lo : lo + step], out[:, lo : lo + step])
            return out
        if self.products and q.tokens.shape[1] == d.tokens.shape[1]:
            return self.by_tokens(q, start, stop, d, q.tokens, d.tokens)
        side = max(1, int(self.cells**0.5))
        for a, b in runs(q.starts[start : stop + 1] - q.starts[start], side):
            tokens = self.tokens_of(q, start + a, start + b)
            if not len(tokens):
                continue
            starts = q.starts[start + a : start + b + 1] - q.starts[start + a]
            for lo, hi in runs(d.starts, max(1, self.cells // len(tokens))):
                best = best_per_text(self.similarities(q, d, tokens, lo, hi), d.starts[lo : hi + 1] - d.starts[lo], d.counts[lo:hi])
                out[a:b, lo:hi] = sum_per_text(best, starts, q.counts[start + a : start + b])
        return out

    def by_tokens(self, q, start, stop, d, asked: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Scores from the tokens ``asked`` of all queries and ``held`` of all documents, in their precision, summed in doubles."""
        out = np.zeros((stop - start, len(d.counts)))
        for a, b in runs(q.starts[start : stop + 1] - q.starts[start], 32 * self.side):
            first, last = q.starts[start + a], q.starts[start + b]
            if first == last:
                continue
            words, word = distinct(asked[first:last])
            for lo, hi in runs(d.starts, max(1, self.cells // self.side)):
                ends = d.starts[lo : hi + 1] - d.starts[lo]
                if not ends[-1]:
                    continue
                tokens, place = distinct(held[d.starts[lo] : d.starts[hi]])
                best = np.zeros((hi - lo, len(words)), asked.dtype)
                step = max(1, min(self.side, self.cells // int(ends[-1])))
                for at in range(0, len(words), step):
                    best[:, at : at + step] = best_of_places(tokens @ words[at : at + step].T, place, ends, d.counts[lo:hi])
                starts, counts = q.starts[start + a : start + b] - first, q.counts[start + a : start + b]
                full = counts > 0
                rows = np.add.reduceat(best[:, word], starts[full], axis=1, dtype=np.float64)
                out[a + np.flatnonzero(full), lo:hi] = rows.T
        return out

    def even(self, q, d) -> bool:
        return bool(q.each and d.each and q.tokens.shape[1] == d.tokens.shape[1])

    @staticmethod
    def by_slots(q: np.ndarray, d: np.ndarray, out: np.ndarray) -> None:
        """Adds to ``out`` the best product of each query's token, token by token."""
        for asked in q:
            top = asked @ d[0].T
            for held in d[1:]:
                np.maximum(top, asked @ held.T, out=top)
            out += top

    def likely(self, q, start, stop, d, floor, k):
        size = q.longest * d.longest
        if not 1e-100 < size < 1e100 or q.tokens.shape[1] != d.tokens.shape[1]:
            return None
        bound = at_least(floor / size - q.counts[start:stop] * error(q.tokens.shape[1]))[:, None]
        if not self.even(q, d):
            found = np.nonzero(self.by_tokens(q, start, stop, d, q.small_tokens, d.small_tokens) >= bound)
            return found if len(found[0]) * 8 <= (stop - start) * len(d.counts) else None
        step, found = max(1, TILE // (stop - start)), []
        for lo in range(0, len(d.counts), step):
            rough = np.zeros((stop - start, min(step, len(d.counts) - lo)), np.float32)
            self.by_slots(q.small[:, start:stop], d.small[:, lo : lo + step], rough)
            row, col = reaching(rough, bound)
            found.append((row, col + lo))
        return joined(found)

    def pairs(self, q, row, d, col):
        out = np.zeros(len(row))
        if not self.even(q, d):
            for i, (a, b) in enumerate(zip(row, col)):
                asked, held = q.tokens[q.starts[a] : q.starts[a + 1]], d.tokens[d.starts[b] : d.starts[b + 1]]
                if len(asked) and len(held):
                    out[i] = (asked @ held.T).max(axis=1).sum()
            return out
        for asked in q.slots:
            tokens = asked[row]
            out += np.max([np.einsum("ij,ij->i", tokens, held[col]) for held in d.slots], axis=0)
        return out


class _Codes:
    """Centroids of the tokens of several texts."""

    def __init__(self, column):
        lists = column.combine_chunks()
        self.counts = lists.value_lengths().to_numpy(zero_copy_only=False)
        self.codes = lists.flatten().to_numpy(zero_copy_only=False)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    @cached_property
    def classes(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Distinct sets of centroids (a column per place, the last one repeated), and the set of each text.

        None if a text has no token, or very many.
        """
        if not len(self.counts) or not 0 < self.counts.min() <= self.counts.max() <= SLOTS:
            return None
        place = np.minimum(np.arange(self.counts.max())[None, :], self.counts[:, None] - 1)
        sets = np.sort(self.codes[self.starts[:-1, None] + place], axis=1)
        again = np.zeros(sets.shape, bool)
        again[:, 1:] = sets[:, 1:] == sets[:, :-1]
        sets = np.sort(np.where(again, sets[:, -1:], sets), axis=1).astype(np.int32)
        order = np.lexsort(sets.T[::-1])
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(sets[order], axis=0) != 0).any(axis=1)
        own = np.empty(len(order), np.int64)
        own[order] = np.cumsum(first) - 1
        return np.ascontiguousarray(sets[order][first].T), own

    @cached_property
    def members(self) -> tuple[np.ndarray, np.ndarray]:
        """Texts by set, in their order, and where each set starts."""
        sets, own = self.classes
        return np.argsort(own, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(own, minlength=sets.shape[1]))])


class CentroidMaxSim(MaxSim):
    """MaxSim with each document token replaced by its centroid.

    Documents of one set of centroids score alike: the sets are scored, and of a set that reaches a query's floor the
    first ``k`` documents stand for all.
    """

    query_columns, doc_columns = ["tokens"], ["codes"]
    query_block, doc_block, first_block = 1_024, 20_000, 4_096
    products = False
    light = True  # a document is a few numbers

    def __init__(self, centroids):
        self.centroids = centroids  # broadcast: {bundle: matrix}

    def queries(self, table, key):
        ragged = Ragged(table["tokens"])
        ragged.centroids = self.centroids.value[key[:2]]
        return ragged

    def docs(self, table, key):
        codes = _Codes(table["codes"])
        codes.longest = np.linalg.norm(self.centroids.value[key[:2]], axis=1).max()
        return codes

    def doc_powers(self, d):
        return np.repeat(powers(np.array([d.longest])), len(d.counts))

    def tokens_of(self, q, start, stop):
        tokens = q.tokens[q.starts[start] : q.starts[stop]]
        return tokens @ q.centroids.T if len(tokens) else tokens

    def similarities(self, q, d, tokens, lo, hi):
        return tokens[:, d.codes[d.starts[lo] : d.starts[hi]]]

    def even(self, q, d) -> bool:
        return bool(q.each and d.classes is not None)

    @staticmethod
    def of_sets(tables: list[np.ndarray], sets: np.ndarray) -> np.ndarray:
        """(set, query) from a table (centroid, query) for each place of a token."""
        shape, kind = (sets.shape[1], tables[0].shape[1]), tables[0].dtype
        step = min(max(1, HOT // max(1, shape[1])), max(1, shape[0]))
        out, top, other = np.zeros(shape, kind), *(np.empty((step, shape[1]), kind) for _ in range(2))
        for lo in range(0, shape[0], step):
            some = slice(lo, min(lo + step, shape[0]))
            best, more, codes = top[: some.stop - lo], other[: some.stop - lo], sets[:, some]
            for table in tables:
                np.take(table, codes[0], axis=0, out=best, mode="clip")
                for code in codes[1:]:
                    np.take(table, code, axis=0, out=more, mode="clip")
                    np.maximum(best, more, out=best)
                np.add(out[some], best, out=out[some])
        return out

    def score(self, q, start, stop, d):
        if not q.starts[stop] - q.starts[start] or not self.even(q, d):
            return super().score(q, start, stop, d)
        sets, own = d.classes
        return self.of_sets([q.centroids @ asked[start:stop].T for asked in q.slots], sets).T[:, own]

    def likely(self, q, start, stop, d, floor, k):
        size = q.longest * d.longest if self.even(q, d) else 0.0
        if not 1e-100 < size < 1e100:
            return None
        sets, _ = d.classes
        texts, starts = d.members
        bound = at_least(floor / size - q.each * error(q.tokens.shape[1]))
        found, step = [], max(1, TILE // (stop - start))
        tables = [(q.centroids @ asked[start:stop].T / size).astype(np.float32) for asked in q.slots]
        for lo in range(0, sets.shape[1], step):
            found.append(reaching(self.of_sets(tables, sets[:, lo : lo + step]), bound) + (lo,))
        each, row = joined([(a + at, b) for a, b, at in found])
        many = np.minimum(np.diff(starts)[each], k)
        ends = np.cumsum(many)
        if len(many) and ends[-1] > LIKELY:
            return None
        inside = np.arange(ends[-1] if len(many) else 0) - np.repeat(ends - many, many)
        return np.repeat(row, many), texts[np.repeat(starts[each], many) + inside]

    def pairs(self, q, row, d, col):
        sets, own = d.classes
        sets, out = sets[:, own[col]], np.zeros(len(row))
        some, at = np.unique(row, return_inverse=True)
        for asked in q.slots:
            table = asked[some] @ q.centroids.T
            out += np.max([table[at, code] for code in sets], axis=0)
        return out


#: Pairs that are scored one by one; where more are likely, all are scored together.
LIKELY = 500_000


class ProductCodes:
    """Product-quantised documents: a table lookup per sub-vector.

    Codes describe what is left of a document after its cell centroid. All
    documents of a chunk share the cell, which is the last key column.
    """

    query_columns, doc_columns = ["embedding"], ["codes"]
    query_block, doc_block = 8_192, 50_000

    def __init__(self, metric: str, centroids, codebooks):
        self.metric = check_metric(metric)
        self.centroids, self.codebooks = centroids, codebooks

    def queries(self, table, key):
        vectors = matrix(table["embedding"])
        if self.metric == "cosine":
            vectors = unit(vectors)
        center = self.centroids.value[key[:2]][key[-1]]
        base = vectors @ center if self.metric != "l2" else np.zeros(len(vectors))
        rest = vectors - center if self.metric == "l2" else vectors
        books = self.codebooks.value[key[:2]]
        pieces = np.split(rest, len(books), axis=1)
        # All documents of the chunk are about as long as their cell's centroid.
        length = max(float(np.linalg.norm(center)), *(float(np.linalg.norm(b, axis=1).max()) for b in books))
        lengths = np.linalg.norm(vectors, axis=1)
        size = np.zeros(len(vectors), np.int64) if self.metric == "cosine" else powers(lengths) + powers(np.array([length]))
        return base, [inner_or_distance(p, b, self.metric) for p, b in zip(pieces, books)], size

    def docs(self, table, key):
        return matrix(table["codes"]).astype(np.int64)

    def query_powers(self, q):
        return q[2]

    def doc_powers(self, d):
        return np.zeros(len(d), np.int64)

    def score(self, q, start, stop, d):
        base, tables, _ = q
        out = np.repeat(base[start:stop, None], len(d), axis=1)
        for piece, table in enumerate(tables):
            out += table[start:stop][:, d[:, piece]]
        return out

    def likely(self, q, start, stop, d, floor, k):
        base, tables, power = q
        own = [table[start:stop].T for table in tables]
        # Sums of the largest values bound what rounding to single precision can do.
        size = np.abs(base[start:stop]) + sum(np.abs(table).max(axis=0) for table in own) + np.abs(floor)
        if not (size.min() > 1e-30 and size.max() < 1e30):
            return None
        if self.metric == "l2":
            own, base = [-table for table in own], -base
        own = [np.ascontiguousarray(table, np.float32) for table in own]
        slack = error(len(own)) * size + 10.0 ** (power[start:stop] - float(SCORE_PLACES))
        bound = (floor - base[start:stop] - slack).astype(np.float32)
        bound = np.nextafter(bound, np.float32(-np.inf))
        step, found = max(1, TILE // (stop - start)), []
        for lo in range(0, len(d), step):
            rough = own[0][d[lo : lo + step, 0]]
            for piece, table in enumerate(own[1:], 1):
                rough += table[d[lo : lo + step, piece]]
            col, row = reaching(rough, bound)
            found.append((row, col + lo))
        return joined(found)

    def pairs(self, q, row, d, col):
        base, tables, _ = q
        out = base[row].copy()
        for piece, table in enumerate(tables):
            out += table[row, d[col, piece]]
        return out


def lists_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every entry of a list column."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy(zero_copy_only=False)


class SmallestCell:
    """Scores of another scorer, for a pair that meets in several cells under the smallest of them only.

    Both sides name all their cells in ``cells``; the cell they meet in is the last key column.
    """

    def __init__(self, scorer):
        self.scorer = scorer
        self.query_columns, self.doc_columns = [*scorer.query_columns, "cells"], [*scorer.doc_columns, "cells"]
        self.query_block, self.doc_block = scorer.query_block, scorer.doc_block

    def _smaller(self, table, key) -> np.ndarray:
        """For each row, which cells below the current one it is in."""
        row, cell = lists_of(table["cells"])
        out = np.zeros((table.num_rows, key[-1]), np.float32)
        below = cell < key[-1]
        out[row[below], cell[below]] = 1
        return out

    def queries(self, table, key):
        return self.scorer.queries(table, key), self._smaller(table, key)

    def docs(self, table, key):
        return self.scorer.docs(table, key), self._smaller(table, key)

    def live(self, q, table, key):
        """Places of the documents that some query may meet here first; None if all are."""
        everywhere = np.flatnonzero(q[1].all(axis=0)) if len(q[1]) else np.zeros(0, np.int64)
        if not len(everywhere):
            return None
        row, cell = lists_of(table["cells"])
        seen = np.zeros(table.num_rows, bool)
        seen[row[np.isin(cell, everywhere)]] = True
        return np.flatnonzero(~seen)

    def query_powers(self, q):
        return self.scorer.query_powers(q[0])

    def doc_powers(self, d):
        return self.scorer.doc_powers(d[0])

    def score(self, q, start, stop, d):
        out = self.scorer.score(q[0], start, stop, d[0])
        out[q[1][start:stop] @ d[1].T > 0] = -np.inf
        return out

    def likely(self, q, start, stop, d, floor, k):
        near = self.scorer.likely(q[0], start, stop, d[0], floor, k)
        if near is None:
            return None
        row, col = near
        first = np.einsum("ij,ij->i", q[1][row + start], d[1][col]) == 0
        return row[first], col[first]

    def pairs(self, q, row, d, col):
        return self.scorer.pairs(q[0], row, d[0], col)


class SharedCell:
    """Scores of another scorer, for pairs that share one of their ``cells``; numbers of cells are below ``many``.

    For searches that bring most pairs together: each pair meets once under its bundle, and not in every cell it shares.
    """

    def __init__(self, scorer, many: int):
        self.scorer, self.words = scorer, max(1, -(-many // 64))
        self.query_columns, self.doc_columns = [*scorer.query_columns, "cells"], [*scorer.doc_columns, "cells"]
        self.query_block, self.doc_block = scorer.query_block, scorer.doc_block
        self.first_block = getattr(scorer, "first_block", scorer.doc_block)
        self.light = getattr(scorer, "light", False)

    def _bits(self, table) -> np.ndarray:
        """The cells of each row as bits."""
        row, cell = lists_of(table["cells"])
        out = np.zeros((table.num_rows, 64 * self.words), bool)
        out[row, cell] = True
        return np.packbits(out, axis=1, bitorder="little").view(np.uint64)

    def queries(self, table, key):
        return self.scorer.queries(table, key), self._bits(table)

    def docs(self, table, key):
        return self.scorer.docs(table, key), self._bits(table)

    def query_powers(self, q):
        return self.scorer.query_powers(q[0])

    def doc_powers(self, d):
        return self.scorer.doc_powers(d[0])

    def score(self, q, start, stop, d):
        out = self.scorer.score(q[0], start, stop, d[0])
        apart = np.ones(out.shape, bool)
        for asked, held in zip(q[1][start:stop].T, d[1].T):
            apart &= (asked[:, None] & held[None, :]) == 0
        out[apart] = -np.inf
        return out

    def likely(self, q, start, stop, d, floor, k):
        near = self.scorer.likely(q[0], start, stop, d[0], floor, k)
        if near is None:
            return None
        row, col = near
        shared = (q[1][row + start] & d[1][col]).any(axis=1)
        return row[shared], col[shared]

    def pairs(self, q, row, d, col):
        return self.scorer.pairs(q[0], row, d[0], col)
