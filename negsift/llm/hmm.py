"""A hidden Markov language model: trained by Baum-Welch, scored by the forward recursion.

Tokens of a text are its words (runs of anything but space and \\x09-\\x0D, with A-Z in
lower case) and then one end. The latent states emit symbols: each of the ``SYMBOLS`` most
frequent tokens is one, and every other word falls into one of ``BUCKETS`` by hash. Given
its bucket, a word has the smoothed share of its count in the bucket, unseen words
together one more word's share, so the model gives every text a probability and
all counts enter it. The emission table's size is a parameter; the vocabulary's is not
bounded and is never in one place.

Counting, training and scoring read all texts. Every task adds up the expected counts of its own
training texts; these are summed by symbol over a shuffle, and the driver sees one row
per symbol. Frequent words, those that are more than one in ``FREQUENT`` of all tokens and so
fewer than that, are looked up in a broadcast table; all other words of a text meet
their counts in a join.

A null text counts as empty and has the end alone. Rows are scored each on their own,
repeated ids too; a null id is in training. An empty table gives an empty result; without
training texts every score is that of an untrained model. Columns other than the id and
the text take no part. Training takes texts beyond ``SEGMENT`` tokens in several sequences,
so that a task's memory does not grow with a text; scoring does not.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from negsift.session import stored

STATES = 8
SYMBOLS = 1 << 14
BUCKETS = 1 << 12
FREQUENT = 1 << 20
ROUNDS = 5
SMOOTHING = 0.1
PRIOR = 100.0  # tokens' worth of the overall shares in each state's emissions
SEGMENT = 1 << 12
END = b"\n"  # no word holds a line end
_FLUSH = 250_000  # distinct words held before a task passes their counts on
_TOKENS = 1_000_000  # tokens in one recursion
_SEED = 7


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def bucket_of(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


# --- counts ------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "many"]
        )

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            for text in batch.column(0).slice(at, 500).to_pylist():
                held.update(tokens(text))
            if len(held) > _FLUSH:
                yield out()
                held.clear()
    yield out()


def counts(training: DataFrame, text_col: str) -> DataFrame:
    """``word, many`` of the training texts."""
    partial = training.select(text_col).mapInArrow(_count, "word binary, many long")
    return partial.groupBy("word").agg(F.sum("many").alias("many"))


@dataclass
class Vocabulary:
    """What scoring knows of all words without holding them."""

    total: int
    distinct: int
    frequent: dict[bytes, int]  # word -> place by falling count; the first ones are symbols
    counts: np.ndarray  # by place
    symbols: int
    buckets: np.ndarray  # per bucket: log10 of (tokens in it + smoothing for its words and one more)

    @property
    def base(self) -> float:
        return float(np.log10(self.total + SMOOTHING * (self.distinct + 1)))


def vocabulary(words: DataFrame) -> Vocabulary:
    """Counts by word, stored, to the bounded part that every task gets."""
    total, distinct = words.agg(F.coalesce(F.sum("many"), F.lit(0)), F.count(F.lit(1))).first()
    found = words.filter(F.col("many").cast("double") * FREQUENT > float(total)).collect()
    found.sort(key=lambda r: (-r["many"], bytes(r["word"])))
    frequent = {bytes(r["word"]): i for i, r in enumerate(found)}
    counted = np.array([r["many"] for r in found], np.int64)
    symbols = min(len(found), SYMBOLS)
    rest = words.groupBy(F.pmod(F.crc32("word"), F.lit(BUCKETS)).alias("bucket")).agg(F.sum("many").alias("many"), F.count(F.lit(1)).alias("words"))
    many, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rest.collect():
        many[r["bucket"]], kinds[r["bucket"]] = r["many"], r["words"]
    for word, place in frequent.items():
        if place < symbols:
            many[bucket_of(word)] -= counted[place]
            kinds[bucket_of(word)] -= 1
    return Vocabulary(total, distinct, frequent, counted, symbols, np.log10(many + SMOOTHING * (kinds + 1)))


# --- texts as symbols ----------------------------------------------------------------


def encode(docs: DataFrame, held_out: Column, id_col: str, text_col: str, shared) -> DataFrame:
    """Each text as symbols, with what is known of its words in the task; the rest as lists.

    ``base`` and ``inside`` (the words within their buckets) take words that are not
    frequent as unseen; :func:`seen` says what their counts add to both.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = (
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_frequent long, base double, inside double, "
        "symbols array<int>, words array<binary>, times array<int>"
    )
    names = [c.strip().split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Vocabulary = shared.value
        place, unseen = known.frequent.get, len(known.counts)
        # By place; the last entry is that of a word that is not frequent.
        logs = np.log10(np.append(known.counts, 0) + SMOOTHING)
        symbol = np.array([i if i < known.symbols else known.symbols + bucket_of(w) for w, i in known.frequent.items()] + [0], np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                held = batch.slice(at, 500)
                texts = [tokens(text) for text in held.column("text").to_pylist()]
                flat = [word for own in texts for word in own]
                sizes = np.array([len(own) for own in texts], np.int64)
                starts = np.cumsum(sizes) - sizes
                places = np.fromiter(map(place, flat, repeat(unseen)), np.int32, len(flat))
                symbols, log = symbol[places], logs[places]
                rare = np.flatnonzero(places == unseen)
                symbols[rare] = known.symbols + np.fromiter((bucket_of(flat[i]) for i in rare.tolist()), np.int32, len(rare))
                bucket = symbols - known.symbols
                inside = np.where(bucket >= 0, log - known.buckets[np.maximum(bucket, 0)], 0.0)
                ends = np.searchsorted(rare, starts + sizes)
                rest = [Counter(flat[i] for i in rare[a:b].tolist()) for a, b in zip([0, *ends[:-1]], ends)]
                n_rare = np.diff(ends, prepend=0)
                kinds = np.cumsum([0, *map(len, rest)]).astype(np.int32)
                words = pa.array([w for own in rest for w in own], pa.binary())
                times = pa.array([n for own in rest for n in own.values()], pa.int32())
                arrays = [
                    *(held.column(c) for c in ("row", "doc_id", "held_out")), pa.array(sizes), pa.array(sizes - n_rare),
                    pa.array(np.add.reduceat(log, starts) - sizes * known.base), pa.array(np.add.reduceat(inside, starts)),
                    pa.ListArray.from_arrays(pa.array(np.append(starts, len(flat)).astype(np.int32)), pa.array(symbols)),
                    pa.ListArray.from_arrays(pa.array(kinds), words), pa.ListArray.from_arrays(pa.array(kinds), times),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(run, schema)


def seen(texts: DataFrame, words: DataFrame) -> DataFrame:
    """``row, more, n_rare``: what the counts of its rarer words add to a text's logarithms.

    No word here is frequent, so none is in more than one of ``FREQUENT`` tokens.
    """
    pairs = texts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    met = pairs.join(words.withColumnRenamed("word", "words"), "words")
    gain = F.col("times") * F.log10((F.col("many") + SMOOTHING) / SMOOTHING)
    return met.groupBy("row").agg(F.sum(gain).alias("more"), F.sum("times").alias("n_rare"))


# --- the model -------------------------------------------------------------------------


@dataclass
class Model:
    """``start[k]``, ``step[from, to]`` and ``emit[symbol, k]`` (a column sums to 1)."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def untrained(weights: np.ndarray, states: int) -> Model:
    """States that tend to stay, each with the symbols' shares shaken by its own noise."""
    noise = np.random.default_rng(_SEED).normal(0, 1, (len(weights), states))
    emit = (weights[:, None] + SMOOTHING) * np.exp(noise)
    step = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


class Sequences:
    """Symbol sequences side by side, the longest first, so that those still running at
    step t are the first ``running[t]``. Step by step they lie one after the other."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        sizes, starts = sizes[self.order], starts[self.order]
        self.length = int(sizes[0]) if len(sizes) else 0
        self.running = np.searchsorted(-sizes, -np.arange(self.length), side="left")
        self.at = np.concatenate([[0], np.cumsum(self.running)])
        nth = np.arange(self.at[-1]) - np.repeat(self.at[:-1], self.running)
        self.symbols = flat[starts[nth] + np.repeat(np.arange(self.length), self.running)]


def forward(model: Model, seqs: Sequences, keep: bool = False, kind=np.float64):
    """log10 likelihood per sequence (in the order given); scaled alphas and scales if ``keep``."""
    start, step = model.start.astype(kind), model.step.astype(kind)
    emitted = model.emit.astype(kind)[seqs.symbols]
    many = len(seqs.order)
    scales = np.empty(seqs.at[-1], kind)
    before = None
    for t in range(seqs.length):
        lo, hi = seqs.at[t], seqs.at[t + 1]
        here = emitted[lo:hi]
        here *= start if t == 0 else before[: hi - lo] @ step
        total = here.sum(axis=1)
        here /= total[:, None]
        scales[lo:hi] = total
        before = here
    logs = np.log10(scales.astype(np.float64))
    nth = np.arange(seqs.at[-1]) - np.repeat(seqs.at[:-1], seqs.running)
    out = np.zeros(many)
    out[seqs.order] = np.bincount(nth, logs, minlength=many)
    return (out, emitted, scales) if keep else out


def expect(model: Model, seqs: Sequences, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, steps and emissions of the sequences, and their log10 likelihood."""
    kind = np.float32
    logs, alpha, scales = forward(model, seqs, keep=True, kind=kind)
    step, emit = model.step.astype(kind), model.emit.astype(kind)
    back = step.T.copy()
    steps = np.zeros_like(model.step)
    beta = None  # of the step after, times its emission over its scale
    for t in range(seqs.length - 1, -1, -1):
        lo, hi = seqs.at[t], seqs.at[t + 1]
        here = alpha[lo:hi]
        now = emit[seqs.symbols[lo:hi]]
        now /= scales[lo:hi, None]
        if beta is not None:
            ended = len(beta)
            steps += here[:ended].T @ beta
            after = beta @ back
            now[:ended] *= after
            here[:ended] *= after
        beta = now
    starts = alpha[: seqs.at[1]].sum(axis=0, dtype=np.float64) if seqs.length else np.zeros(len(model.start))
    emits = np.stack([np.bincount(seqs.symbols, alpha[:, k], minlength=symbols) for k in range(alpha.shape[1])], axis=1)
    return starts, steps * model.step, emits, float(logs.sum())


def _chunks(batches: Iterator[pa.RecordBatch], segment: int | None, most: int = _TOKENS) -> Iterator[tuple[pa.RecordBatch, Sequences]]:
    """Runs of rows of about ``most`` tokens."""
    for batch in batches:
        lists = batch.column("symbols")
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        long = np.nonzero(np.diff(offsets) > most)[0]  # each of these alone
        cuts = np.searchsorted(offsets, np.arange(offsets[0], offsets[-1], most))
        cuts = np.unique(np.concatenate([[0], cuts, long, long + 1, [batch.num_rows]]))
        cuts = cuts[cuts <= batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            starts, sizes = offsets[lo:hi].astype(np.int64), np.diff(offsets[lo : hi + 1]).astype(np.int64)
            if segment:
                parts = -(-sizes // segment)
                nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                starts, sizes = np.repeat(starts, parts) + nth * segment, np.minimum(np.repeat(sizes, parts) - nth * segment, segment)
            yield batch.slice(lo, hi - lo), Sequences(flat, starts, sizes)


def _expected(shared, symbols: int, states: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        starts, steps, emits, likelihood = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)), 0.0
        for _, seqs in _chunks(batches, SEGMENT):
            a, b, c, d = expect(model, seqs, symbols)
            starts, steps, emits, likelihood = starts + a, steps + b, emits + c, likelihood + d
        used = np.nonzero(emits.any(axis=1))[0]
        # Below the symbols: the starts, a row per state for the steps, the likelihood.
        table = np.vstack([emits[used], starts, steps, np.full(states, likelihood)])
        keys = np.concatenate([used, -1 - np.arange(states + 2)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), *[pa.array(table[:, k].copy()) for k in range(states)]],
            names=["key", *[f"s{k}" for k in range(states)]],
        )

    return run


def train(texts: DataFrame, symbols: int, weights: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch over all rows of ``texts`` (``symbols``); also the log10 likelihood before each round."""
    spark, model, history = texts.sparkSession, untrained(weights, states), []
    schema = "key int, " + ", ".join(f"s{k} double" for k in range(states))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        partial = texts.select("symbols").mapInArrow(_expected(shared, symbols, states), schema)
        sums = partial.groupBy("key").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)]).toArrow()
        shared.unpersist()
        keys = sums["key"].to_numpy()
        table = np.stack([sums[f"s{k}"].to_numpy() for k in range(states)], axis=1)
        full = np.zeros((symbols, states))
        full[keys[keys >= 0]] = table[keys >= 0]
        other = {int(k): row for k, row in zip(keys, table) if k < 0}
        if not other:
            break
        history.append(float(other[-2 - states][0]))
        start = other[-1] + SMOOTHING
        step = np.stack([other[-2 - k] for k in range(states)]) + SMOOTHING
        # Every state keeps room for every symbol, by the symbols' overall shares.
        shares = (full.sum(axis=1, keepdims=True) + 1) / (full.sum() + symbols)
        emit = full + PRIOR * shares
        model = Model(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model, history


def likelihood(model: Model, symbols: np.ndarray, step: int = _TOKENS) -> float:
    """log10 likelihood of one sequence, ``step`` tokens at a time."""
    total, start = 0.0, model.start
    for at in range(0, len(symbols), step):
        part = symbols[at : at + step]
        seqs = Sequences(part, np.zeros(1, np.int64), np.array([len(part)]))
        logs, alpha, _ = forward(Model(start, model.step, model.emit), seqs, keep=True)
        total += float(logs[0])
        start = alpha[-1] @ model.step
    return total


def _likelihoods(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for rows, seqs in _chunks(batches, None, _TOKENS // 2):
            if rows.num_rows == 1:
                logs = np.array([likelihood(model, seqs.symbols)])
            else:
                logs = forward(model, seqs)
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(logs)], names=["row", "log"])

    return run


def score(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    Learns from the rows that are not ``held_out``. ``base_score`` is that of smoothed
    single-token shares. Both are sums of log10 over all tokens.
    """
    spark = docs.sparkSession
    words = stored(counts(docs.filter(~F.coalesce(held_out, F.lit(False))), text_col), "words")
    known = vocabulary(words)
    texts = stored(encode(docs, held_out, id_col, text_col, spark.sparkContext.broadcast(known)), "symbols")
    symbols = known.symbols + BUCKETS
    weights = np.zeros(symbols)
    weights[: known.symbols] = known.counts[: known.symbols]
    weights[known.symbols :] = 10**known.buckets
    model, _ = train(texts.filter(~F.col("held_out")), symbols, weights, states, rounds)
    shared = spark.sparkContext.broadcast(model)
    logs = texts.select("row", "symbols").mapInArrow(_likelihoods(shared), "row long, log double")
    rare = seen(texts, words)
    plain = texts.drop("symbols", "words", "times")
    joined = plain.join(logs, "row").join(rare, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("log") + F.col("inside") + more).alias("score"),
    )
