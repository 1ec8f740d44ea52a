"""Ranked lexical search with duplicate bags scored once.

Each item is a bag of terms (``alnum.words``, repeats count). A document is restricted to
the vocabulary of the items: what is left is its bag of term counts, and ``m``, a number
of its length. Documents that agree in both score alike for every item, so they form a
class: documents meet by a hash of bag and ``m``, and are one class only if both are
equal byte by byte. Classes are scored once; an item's k best documents lie in its k best classes,
by score and then by smallest document id, and only members of these are looked up, in
ascending order of their ids. Nothing is approximate.

With N documents that hold a term, L terms in them, n in one, df documents with a term:
a term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``, ``m = 75 + 25 n N div L``, and a
document's score the sum of ``w * (10^9 tf div (1000 tf + 12 m))`` over the item's terms. Sums are
taken in doubles only where they are proven to stay whole, below 2^53, else in integers.

Items are taken in blocks of at most ``block_bytes`` of text (one text at least), each of
which reads the documents once; a block's vocabulary and bags are what tasks get to
hold, whatever the number of items. A task keeps the best k rows per item, so it sends
k rows per item at most.

Null and empty texts hold no term: as documents they take no part, as items they find
nothing. Repeated documents are members of one class and each have a rank; repeated items are
answered each on their own. A null document id comes after all others. Empty tables
give an empty result. Columns other than id and text take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from negsift.llm.alnum import texts, words
from negsift.session import stored

BLOCK_BYTES = 8 << 20
_BROADCAST = 64 << 20  # bytes of winning classes that may go to all tasks
_CELLS = 1 << 22  # of a matrix: documents by terms, or terms by items
_HELD = 1 << 19  # rows kept before the best are picked again
_EXACT = 1 << 53


class Items:
    """The bags of a block of items over their own vocabulary."""

    def __init__(self, bags: list[list[bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        term, item, many, self.terms = [], [], [], np.zeros(len(bags), np.int64)
        for i, bag in enumerate(bags):
            self.terms[i] = len(bag)
            for word, n in Counter(bag).items():
                term.append(self.vocabulary.setdefault(word, len(self.vocabulary)))
                item.append(i)
                many.append(n)
        self.term, self.item, self.many = (np.array(x, np.int64) for x in (term, item, many))

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of items whose matrix of terms by items is small: items, terms, and where in the matrix which count stands."""
        starts = np.searchsorted(self.item, np.arange(len(self.terms) + 1))
        lo = 0
        while lo < len(self.terms):
            hi = lo + 1
            while hi < len(self.terms) and (starts[hi + 1] - starts[lo]) * (hi + 1 - lo) <= _CELLS:
                hi += 1
            at = slice(starts[lo], starts[hi])
            own, place = np.unique(self.term[at], return_inverse=True)
            yield np.arange(lo, hi), own, place * (hi - lo) + self.item[at] - lo, self.many[at]
            lo = hi


def _bags(vocabulary):
    """``id, n, bag`` of each text: its number of terms, and ids and counts of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for held, some in texts(batches):
            sizes, bags = [], []
            for text in some:
                found = words(text)
                counts = sorted((known[w], n) for w, n in Counter(found).items() if w in known)
                sizes.append(len(found))
                bags.append(np.array(counts, "<u4").T.tobytes())
            yield pa.RecordBatch.from_arrays([held.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"])

    return run


def _unpacked(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every entry of some bags."""
    parts = [np.frombuffer(b, "<u4").reshape(2, -1).astype(np.int64) for b in bags.to_pylist()]
    row = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
    term, many = np.concatenate([np.zeros((2, 0), np.int64), *parts], axis=1)
    return row, term, many


def _document_counts(terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            row, term, _ = _unpacked(batch.column(0))
            np.add.at(total, term, batch.column(1).to_numpy()[row])
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    return run


def _best(found: list[pa.RecordBatch], k: int) -> pa.Table:
    """The k best rows of each item: highest score first, then smallest id."""
    order = [("item", "ascending"), ("score", "descending"), ("least", "ascending"), ("class", "ascending")]
    rows = pa.Table.from_batches(found).sort_by(order).combine_chunks()
    item = rows["item"].to_numpy()
    first = np.searchsorted(item, item)
    return rows.filter(pa.array(np.arange(len(item)) - first < k))


def _scores(items, weights: np.ndarray, k: int):
    """The k best classes of each item in a task, from ``class, least, m, bag``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: Items = items.value
        exact = weights.max(initial=0) * 10**6 * of.terms.max(initial=0) < _EXACT
        kind = np.float64 if exact else np.int64
        floor = np.ones(len(of.terms), np.int64)
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for found in score(batch.slice(at, 1000), floor, kind, of):
                    held.append(found)
                    rows += found.num_rows
                    if rows >= _HELD:
                        best = _best(held, k)
                        held, rows = best.to_batches(), best.num_rows
                        item, many = np.unique(best["item"].to_numpy(), return_counts=True)
                        last = np.cumsum(many) - 1
                        floor[item[many == k]] = best["score"].to_numpy()[last[many == k]]
        if held:
            yield from _best(held, k).to_batches()

    def score(batch: pa.RecordBatch, floor: np.ndarray, kind, of: Items) -> Iterator[pa.RecordBatch]:
        row, term, tf = _unpacked(batch.column(3))
        value = weights[term] * (10**9 * tf // (1000 * tf + 12 * batch.column(2).to_numpy()[row]))
        for own, terms, place, many in of.slices():
            asked = np.zeros(len(terms) * len(own), kind)
            asked[place] = many
            asked = asked.reshape(len(terms), len(own))
            column = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
            here = np.nonzero(terms[column] == term)[0] if len(terms) else row[:0]
            step = max(1, _CELLS // max(len(terms), 1))
            for lo in range(0, batch.num_rows, step):
                hi = min(lo + step, batch.num_rows)
                some = here[np.searchsorted(row[here], lo) : np.searchsorted(row[here], hi)]
                held = np.zeros((hi - lo, len(terms)), kind)
                held[row[some] - lo, column[some]] = value[some]
                total = (held @ asked).astype(np.int64)
                a, b = np.nonzero(total >= floor[own])
                at = pa.array(a + lo)
                columns = [pa.array(own[b]), pa.array(total[a, b]), batch.column(0).take(at), batch.column(1).take(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "score", "class", "least"])

    return run


def _ranked(rows: DataFrame, by: str, k: int, *order) -> DataFrame:
    """The first ``k`` rows of each ``by``; what leaves a task is cut to ``k`` as well."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= k)


def _of_block(docs: DataFrame, texts_of: list[str | None], k: int) -> DataFrame | None:
    """``item, rank, doc_id, score`` for a block of items, by their place in it."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    items = Items([words((t or "").encode()) for t in texts_of])
    vocabulary = spark.sparkContext.broadcast(items.vocabulary)
    bags = stored(docs.mapInArrow(_bags(vocabulary), f"doc_id {kind}, n long, bag binary").filter("n > 0"), "bags")
    total = bags.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not total[0]:
        return None
    m = F.expr(f"75 + (25 * n * {total[0]}L) div {total[1]}L")
    bags = bags.filter(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag")
    bags = bags.withColumn("hash", F.xxhash64("m", "bag"))

    # Rows meet by their hash; that they are equal is seen in what they are grouped by.
    classes = bags.groupBy("hash", "m", "bag").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("members"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "bag-classes")
    counted = classes.select("bag", "members").mapInArrow(_document_counts(len(items.vocabulary)), "term long, df long")
    df = np.zeros(len(items.vocabulary), np.int64)
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    weights = np.floor(1000 * np.log((2 * total[0] + 2) / (2 * df + 1))).astype(np.int64)

    shared = spark.sparkContext.broadcast(items)
    found = classes.select("class", "least", "m", "bag").mapInArrow(_scores(shared, weights, k), f"item long, score long, class long, least {kind}")
    best = _ranked(found, "item", k, F.desc("score"), F.asc_nulls_last("least"), "class")
    best = stored(best.select("item", "score", "class"), "best-classes")

    won = stored(classes.join(best.select("class").distinct(), "class", "left_semi").select("class", "hash", "m", "bag"), "won-classes")
    size = won.agg(F.sum(F.length("bag") + 32)).first()[0] or 0
    members = bags.join(F.broadcast(won) if size <= _BROADCAST else won, ["hash", "m", "bag"]).select("class", "doc_id")
    members = _ranked(members, "class", k, F.asc_nulls_last("doc_id")).drop("rank")
    expanded = best.join(members, "class").select("item", "score", "doc_id")
    return _ranked(expanded, "item", k, F.desc("score"), F.asc_nulls_last("doc_id")).select("item", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest scores above 0 of each item, ties to the smaller id."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    asked = stored(asked.filter(F.length("text") > 0), "items")
    blocks = -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    parts = []
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("row").collect()
        found = _of_block(docs, [r["text"] for r in own], k) if own else None
        if found is None:
            continue
        names = stored(spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item long, item_id {dict(asked.dtypes)['item_id']}"), "block")
        parts.append(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        kinds = dict(asked.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    return reduce(DataFrame.union, parts)
