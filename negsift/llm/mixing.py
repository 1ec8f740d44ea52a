"""Mixing by soft membership: rates per document that give each domain its target tokens.

A labelled table gives some documents a 0 or 1 for each of a few labels; a domain is one
value for each. For every label a Bernoulli naive Bayes classifier over the words that
tell its two values apart gives each document a posterior, and their products are
the posteriors of the domains. The rates r >= 0 then minimise the squared distance of
the expected domain totals, sum of r * tokens * posterior, to the targets, and stay near 1
as far as that allows: projected gradient descent from r = 1 that projects the sum of all
steps, scaled by the tokens of a document and by the inverse of the posteriors' second
moments, each step one sum over the whole table. A document's rate follows from its
posteriors and that sum, so no rate is stored between steps and only sums per domain
come to the driver.

A rate of 2.3 stands for two copies and a third with chance 0.3, decided by a hash.

The classifier learns from at most ``max_labelled`` labelled rows (by hash order). For toxicity it
keeps every word, without the symbols around it, that the labels speak clearly for: toxic words are
many, rare, and of all languages, and a fixed number of them leaves those of small languages out. For
other labels it keeps at most ``max_features`` words and word endings, symbols included; more of them say the
same again and make the posteriors worse. Everything else covers all rows. A document labelled twice counts with its smallest labels; null labels are
left out; without any labelled row every domain is equally likely, and no rate can change the mix. A null text
counts as empty: it has the domains' prior probabilities and 0 tokens. Repeated rows
have equal rates and their own copies. An empty table gives an empty result.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from negsift.llm.frames import fresh, row_key, small_table, words as words_of
from negsift.session import stored

MAX_LABELLED = 20_000
MAX_FEATURES = 32
RATIO = 2.0
MIN_DOCS = 3
MIN_SCORE = 5.0  # standard deviations between the documents with the label that hold a word, and those to be expected
PRIOR = 5.0
MAX_STEPS = 100
TOLERANCE = 1e-5  # of all tokens
RIDGE = 1e-6
_BIAS = " "  # no word: stands in every document
_ENDING = " ends "
_BARE = " bare "  # a word that a text holds between symbols only
_SYMBOLS = string.punctuation + "“”„‘’‚«»‹›…–—¿¡。、"
_LITERAL = 5_000  # weights that stand in the plan itself

#: The labels of the ``labels`` table. A domain is one value for each, in binary order.
LABELS = ["quality", "toxic"]
#: Labels told by as many words as are clear, not by the clearest few.
BY_WORDS = {"toxic"}
DOMAINS = ["low_clean", "low_toxic", "high_clean", "high_toxic"]
#: Shares of the tokens that a mix should have.
TARGETS = {"low_clean": 0.12, "low_toxic": 0.01, "high_clean": 0.85, "high_toxic": 0.02}
#: The same where low quality has been filtered out before: clean, toxic.
TOXIC_TARGETS = [0.98, 0.02]


def labelled(labels: DataFrame, names: list[str] = LABELS, id_col: str = "doc_id") -> DataFrame:
    """``doc_id`` and its labels, a row per id; rows with a null or another value are left out."""
    known = labels.select(F.col(id_col).alias("doc_id"), *[F.col(n).cast("int").alias(n) for n in names])
    for name in names:
        known = known.filter(F.col(name).isin(0, 1))
    least = F.min(F.struct(*names))
    return known.filter("doc_id is not null").groupBy("doc_id").agg(least.alias("l")).select("doc_id", "l.*")


def features(text: Column) -> Column:
    """Distinct words, the distinct last characters of words, and the words met between symbols only, of a text; the bias."""
    plain = F.array_distinct(words_of(F.lower(text)))
    endings = F.transform(plain, lambda w: F.concat(F.lit(_ENDING), F.right(w, F.lit(1))))
    inner = F.array_except(F.transform(plain, lambda w: F.btrim(w, F.lit(_SYMBOLS))), plain)
    bare = F.transform(inner, lambda w: F.concat(F.lit(_BARE), w))
    return F.concat(plain, F.array_distinct(endings), bare, F.array(F.lit(_BIAS)))


def _met(plain: Column, text: Column, known: list[str]) -> Column:
    """Those of the features of a text that are ``known``, from its distinct lower-case words ``plain``.

    The same as meeting :func:`features` with them, but words are looked up before anything
    is built from them, and symbols cut off only where a word has any.
    """
    words = [f for f in known if not f.startswith(" ")]
    bare = [f.removeprefix(_BARE) for f in known if f.startswith(_BARE)]
    endings = [f for f in known if f.startswith(_ENDING)]
    found = [F.array(F.lit(_BIAS))]
    if words:
        found.append(F.filter(plain, lambda w: w.isin(words)))
    if bare:
        symbols = list(_SYMBOLS)
        outer = F.filter(plain, lambda w: F.left(w, F.lit(1)).isin(symbols) | F.right(w, F.lit(1)).isin(symbols))
        inner = F.filter(F.array_distinct(F.transform(outer, lambda w: F.btrim(w, F.lit(_SYMBOLS)))), lambda w: w.isin(bare))
        found.append(F.transform(F.array_except(inner, plain), lambda w: F.concat(F.lit(_BARE), w)))
    if endings:
        # One pass over the words for all endings; a search of the text for each of them costs far more.
        last = F.filter(F.transform(plain, lambda w: F.right(w, F.lit(1))), lambda c: c.isin([e.removeprefix(_ENDING) for e in endings]))
        found.append(F.transform(F.array_distinct(last), lambda c: F.concat(F.lit(_ENDING), c)))
    return F.concat(*found)


def _stem(feature: Column) -> Column:
    """The word of a feature without symbols around it; null for endings, the bias and words with symbols."""
    word = F.when(feature.startswith(_BARE), F.substring(feature, len(_BARE) + 1, 1 << 30)).when(~feature.startswith(" "), feature)
    return F.when((word != "") & (word == F.btrim(word, F.lit(_SYMBOLS))), word)


def classifier(
    docs: DataFrame, labels: DataFrame, names: list[str] = LABELS, id_col="doc_id", text_col="text",
    max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES,
) -> list[dict]:
    """Weights ``feature, w``: per label what the feature adds to the log odds of its being 1.

    A feature is used for a label if its share among the documents with the label is at
    least ``RATIO`` times that among those without, or the other way; of those, the ones
    that the counts speak most clearly for. For labels ``BY_WORDS`` these are all words in at least ``MIN_DOCS``
    documents and ``MIN_SCORE`` standard deviations off; a document holds a word plainly or between symbols,
    never both, so either feature has the word's weight.
    """
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    chosen = chosen.select(F.col("doc_id").alias("_of"), *names)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_of"))
    pairs = texts.select(*names, features(F.col("_text")).alias("found")).select(*names, F.explode_outer("found").alias("feature"))
    with_label = [F.sum(n).cast("double").alias(n) for n in names]
    counts = stored(pairs.groupBy("feature").agg(F.count(F.lit(1)).cast("double").alias("docs"), *with_label), "feature-counts")
    whole = counts.filter(F.col("feature") == _BIAS).first()
    weights: dict[str, list[float]] = {_BIAS: [0.0] * len(names)}
    if whole is None:
        return [{"feature": k, "w": w} for k, w in weights.items()]
    for i, name in enumerate(names):
        ones, zeros = whole[name], whole["docs"] - whole[name]
        weights[_BIAS][i] += float(np.log((ones + 1) / (zeros + 1)))
        if not ones or not zeros:
            continue
        # Both shares start from the overall one, with the weight of PRIOR documents.
        overall = F.col("docs") / float(whole["docs"])
        share = (F.col(name) + PRIOR * overall) / (ones + PRIOR)
        other = (F.col("docs") - F.col(name) + PRIOR * overall) / (zeros + PRIOR)
        clear = F.abs(share - other) / F.sqrt(overall * (1 - overall) + 1e-9)
        apart = F.greatest(share / other, other / share) >= RATIO
        columns = ["feature", share.alias("a"), other.alias("b"), clear.alias("c")]
        if name in BY_WORDS:
            words = counts.select(_stem(F.col("feature")).alias("feature"), "docs", name).filter("feature is not null")
            words = words.groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum(name).alias(name))
            expected = F.col("docs") * float(ones / whole["docs"])
            spread = expected * float(zeros / whole["docs"]) * (1 - (F.col("docs") - 1) / max(whole["docs"] - 1, 1.0))
            score = F.abs(F.col(name) - expected) / F.sqrt(spread + 1e-9)
            best = words.filter(apart & (F.col("docs") >= MIN_DOCS) & (F.round(score, 9) >= MIN_SCORE)).select(*columns)
        else:
            best = counts.filter((F.col("feature") != _BIAS) & ~F.col("feature").startswith(_BARE) & apart).select(*columns)
            best = best.orderBy(F.desc(F.round("c", 9)), "feature").limit(max_features)
        for r in sorted(best.collect(), key=lambda r: r["feature"]):
            a, b = min(r["a"], 1 - 1e-6), min(r["b"], 1 - 1e-6)
            for feature in [r["feature"], _BARE + r["feature"]] if name in BY_WORDS else [r["feature"]]:
                weights.setdefault(feature, [0.0] * len(names))[i] += float(np.log(a / b) - np.log((1 - a) / (1 - b)))
            weights[_BIAS][i] += float(np.log((1 - a) / (1 - b)))
    return [{"feature": k, "w": w} for k, w in weights.items()]


def posteriors(docs: DataFrame, weights: list[dict], labels: int = len(LABELS), id_col="doc_id", text_col="text") -> DataFrame:
    """``key, doc_id, tokens, rows, p``; ``key`` is a digest of id and text.

    ``p`` has a probability per domain: the product of those of its labels. Rows of one
    key are one row here, with their number in ``rows``.
    """
    schema, spark = "feature string, w array<double>", docs.sparkSession
    model = small_table(spark, weights, schema) if len(weights) <= _LITERAL else spark.createDataFrame(weights, schema)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        row_key(F.col(id_col), text).alias("key"), F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("_row"),
        text.alias("text"), words_of(F.lower(text)).alias("words"),
    )
    rows = rows.withColumns({"tokens": F.size("words").cast("long"), "words": F.array_distinct("words")})
    known = [w["feature"] for w in weights]
    found = _met(F.col("words"), F.col("text"), known) if len(known) <= _LITERAL else features(F.col("text"))
    rows = rows.select("key", "doc_id", "_row", "tokens", found.alias("found"))
    # A text meets few of the words that count, and always the bias. From a plain explode Spark
    # would derive a filter on the list, and make the list twice for it.
    met = rows.select("key", "doc_id", "_row", "tokens", F.explode_outer("found").alias("feature")).join(F.broadcast(model) if len(weights) <= _LITERAL else model, "feature")
    sums = met.groupBy("key", "doc_id", "tokens", "_row").agg(*[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(labels)])
    sums = sums.groupBy("key", "doc_id", "tokens").agg(F.count(F.lit(1)).alias("rows"), *[F.min(f"s{i}").alias(f"s{i}") for i in range(labels)])
    ones = [F.round(1 / (1 + F.exp(-F.col(f"s{i}"))), 6) for i in range(labels)]
    domains = []
    for d in range(1 << labels):
        p = F.lit(1.0)
        for i, one in enumerate(ones):
            p = p * (one if d >> (labels - 1 - i) & 1 else 1 - one)
        domains.append(p)
    return sums.select("key", "doc_id", "tokens", "rows", F.array(*domains).alias("p"))


def rate(p: Column, way: list[float]) -> Column:
    """A document's rate, from its posteriors and the sum of all steps: 1 less its share of them, or 0."""
    along = sum((F.get(p, F.lit(c)) * F.lit(x) for c, x in enumerate(way)), F.lit(0.0))
    return F.greatest(F.lit(0.0), 1 - along)


def fit(rows: DataFrame, shares: list[float]) -> list[float]:
    """The sum of the projected gradient's steps, for rows with ``tokens, rows, p``.

    What falls is the squared distance of the totals to their targets, over RIDGE, and
    that of the rates to 1; the second, far lighter, decides between rates that give equal totals. The steps are
    added up and their sum is projected. They are scaled by the second moments of the
    posteriors whose rates are above 0, and halved where that goes too far. Targets out of
    reach are met as nearly as they can be.
    """
    classes = len(shares)
    p = [F.get("p", F.lit(c)) for c in range(classes)]
    weight = (F.col("tokens") * F.col("rows")).cast("double")
    pairs = [(a, b) for a in range(classes) for b in range(classes)]
    goal = np.array(shares) / sum(shares)
    way, step, last = np.zeros(classes), np.zeros(classes), np.inf
    for _ in range(MAX_STEPS):
        now = _digits(way + step)
        at = rows.select(weight.alias("_n"), "p", rate(F.col("p"), now.tolist()).alias("_r"))
        moving = F.when(F.col("_r") > 0, F.col("_n")).otherwise(0.0)
        totals = [F.sum(F.col("_n") * F.col("_r") * x) for x in p]
        found = at.agg(F.sum("_n"), F.sum(F.col("_n") * F.col("_r") * F.col("_r")), *totals, *[F.sum(moving * p[a] * p[b]) for a, b in pairs]).first()
        if not found[0]:
            return [0.0] * classes
        sums = np.array(found[1:], float) / found[0]
        # The dual of the problem, whose slope is what the totals lack.
        value = sums[0] / 2 + now @ goal + RIDGE / 2 * now @ now
        if value > last * (1 + 1e-12):
            step = step / 2
            if np.abs(step).max() < 1e-9:
                break
            continue
        way, last = now, value
        slope = sums[1 : classes + 1] - goal - RIDGE * now
        if np.abs(slope).max() <= TOLERANCE:
            break
        step = np.linalg.solve(sums[classes + 1 :].reshape(classes, classes) + RIDGE * np.eye(classes), slope)
    return way.tolist()


def _digits(values: np.ndarray) -> np.ndarray:
    """Nine digits: what is beyond them depends on the order of the sums."""
    return np.array([float(f"{x:.9g}") for x in values])


def mixed(docs: DataFrame, labels: DataFrame, shares: list[float], names: list[str] = LABELS, id_col="doc_id", text_col="text") -> DataFrame:
    """``key, doc_id, tokens, rows, p, rate`` of every document; ``labels`` as :func:`labelled` gives them."""
    weights = classifier(docs, labels, names, id_col, text_col)
    rows = stored(posteriors(docs, weights, len(names), id_col, text_col), "posteriors")
    return rows.withColumn("rate", F.round(rate(F.col("p"), fit(rows, shares)), 9))


def copies(value: Column, key: Column) -> Column:
    """A rate as a whole number: the rest beyond it is one more with that chance, by hash."""
    chance = F.pmod(F.xxhash64(F.lit("mix"), key), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(value) + F.when(chance < value - F.floor(value), 1).otherwise(0)).cast("int")


def resample(docs: DataFrame, labels: DataFrame, shares: list[float], names: list[str] = LABELS, id_col="doc_id", text_col="text") -> DataFrame:
    """``docs`` with every row left out or repeated by its rate, and no other column."""
    found = mixed(docs, labels, shares, names, id_col, text_col)
    many, key = fresh(docs, "_many"), fresh(docs, "_key")
    wanted = found.select(F.col("key").alias(key), copies(F.col("rate"), F.col("key")).alias(many)).filter(F.col(many) > 0)
    rows = docs.withColumn(key, row_key(F.col(id_col), F.col(text_col))).join(wanted, key)
    return rows.withColumn(many, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*docs.columns)
