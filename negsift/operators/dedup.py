"""Merging documents with identical text and following their ids.

Grouping is on a digest of the text, so the shuffles carry ids, positions and 32
bytes per document and the bodies stay where they are read. Copies are combined
before the shuffle; a text that fills a third of the corpus costs one row per
task there, and is looked up through :func:`lookup` afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from negsift.functions.text import text_key
from negsift.operators.positions import by_position
from negsift.operators.skew import HOT_ROWS, hot_keys, hottest, lookup
from negsift.schema import Bundle, KEYS
from negsift.session import stored


def text_keys(corpus: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Id, position and text digest of each document: all that dedup needs.

    Every function here takes this table in place of the corpus as well. Store it
    when several of them are called, so that the texts are read once.
    """
    if "text_key" in corpus.columns:
        return corpus
    return corpus.select(*keys, "document_id", "pos", text_key(F.col("document")).alias("text_key"))


def canonical_ids(corpus: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Per distinct text: the first-seen id, its position and the number of copies."""
    return (
        text_keys(corpus, keys)
        .groupBy(*keys, "text_key")
        .agg(
            F.min_by("document_id", "pos").alias("canonical_id"),
            F.min("pos").alias("first_pos"),
            F.count(F.lit(1)).alias("copies"),
        )
    )


def _with_canonical(corpus: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    # Both sides of the lookup keep the same columns, so that Spark plans the
    # grouping once and reuses its exchange.
    canonical = canonical_ids(corpus, keys)
    return lookup(
        text_keys(corpus, keys),
        canonical,
        [*keys, "text_key"],
        hottest(canonical, "copies", hot_rows),
        spread=F.encode(F.concat(F.lit("row "), F.col("pos").cast("string")), "utf-8"),
    )


def id_map(corpus: DataFrame, keys: list[str] = KEYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``document_id -> canonical_id`` for every id.

    An id that stands for several texts follows its last one.
    """
    return (
        _with_canonical(corpus, keys, hot_rows)
        .groupBy(*keys, "document_id")
        .agg(F.max_by("canonical_id", "pos").alias("canonical_id"))
    )


def dedup_corpus(
    corpus: DataFrame, keys: list[str] = KEYS, hot_rows: int = HOT_ROWS, digests: DataFrame | None = None
) -> DataFrame:
    """The first row of each text, as it is.

    Written as "all rows but the later copies", whose positions are told by bitmaps where the
    bodies are read; only beyond their limit is the corpus shuffled, once, by position.
    """
    known = _with_canonical(corpus if digests is None else digests, keys, hot_rows)
    later = known.filter(F.col("pos") > F.col("first_pos")).select(*keys, "pos")
    return by_position(corpus, later, keep=False, keys=keys)


def remap_qrels(qrels: DataFrame, mapping: DataFrame, keys: list[str] = KEYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Judgements on canonical ids, each (query, document) once at its first position."""
    on = [*keys, "document_id"]
    hot = mapping.join(hot_keys(qrels, on, hot_rows), on, "left_semi")
    found = lookup(qrels, mapping, on, hot, F.concat(F.lit("row "), F.col("pos").cast("string")))
    return (
        found.withColumn("document_id", F.coalesce("canonical_id", "document_id"))
        .groupBy(*keys, "query_id", "document_id")
        .agg(F.min("pos").alias("pos"))
    )


def dedup_bundle(bundle: Bundle, hot_rows: int = HOT_ROWS) -> Bundle:
    """Corpus and judgements without copies. The digests are written once for both."""
    digests = stored(text_keys(bundle.corpus), "text-keys")
    return Bundle(
        bundle.queries,
        dedup_corpus(bundle.corpus, hot_rows=hot_rows, digests=digests),
        remap_qrels(bundle.qrels, id_map(digests, hot_rows=hot_rows), hot_rows=hot_rows),
    )


def group_qrels(qrels: DataFrame) -> DataFrame:
    """One row per query with its document ids in source order."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "document_id")))
    return qrels.groupBy(*KEYS, "query_id").agg(
        F.transform(listed, lambda entry: entry["document_id"]).alias("document_ids")
    )


def remap_scores(
    scores: DataFrame, mapping: DataFrame, keys: list[str] = KEYS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Score lists on canonical ids; a repeated id keeps its first place and score.

    An unretrieved positive at the head therefore keeps -1 even if a copy of it
    was retrieved further down. A row with an empty list stays a row, and two rows of one
    query stay two.
    """
    row = [*keys, "query_id", "split"]
    on = [*keys, "document_id"]
    entries = scores.withColumn("_row", F.monotonically_increasing_id()).select(
        *row, "_row", F.posexplode_outer(F.arrays_zip("document_ids", "scores")).alias("place", "entry")
    ).select(*row, "_row", "place", F.col("entry.document_ids").alias("document_id"), F.col("entry.scores").alias("score"))
    hot = mapping.join(hot_keys(entries.filter("document_id is not null"), on, hot_rows), on, "left_semi")
    spread = F.concat_ws(" ", F.lit("row"), "query_id", F.col("place").cast("string"))
    first = (
        lookup(entries, mapping, on, hot, spread)
        .groupBy(*row, "_row", F.coalesce("canonical_id", "document_id").alias("document_id"))
        .agg(F.min("place").alias("place"), F.min_by("score", "place").alias("score"))
    )
    entry = F.when(F.col("document_id").isNotNull(), F.struct("place", "document_id", "score"))
    return (
        first.groupBy(*row, "_row")
        .agg(F.array_sort(F.collect_list(entry)).alias("list"))
        .select(
            *row,
            F.transform("list", lambda e: e["document_id"]).alias("document_ids"),
            F.transform("list", lambda e: e["score"]).alias("scores"),
        )
    )


def dedup_report(corpus: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Per bundle: documents before and after, removed, percent, ids remapped."""
    counts = canonical_ids(corpus, keys).groupBy(*keys).agg(
        F.sum("copies").alias("before"), F.count(F.lit(1)).alias("after")
    )
    remapped = id_map(corpus, keys).groupBy(*keys).agg(
        F.count_if(F.col("document_id") != F.col("canonical_id")).alias("ids_remapped")
    )
    removed = F.col("before") - F.col("after")
    return counts.join(remapped, keys).select(
        *keys, "before", "after", removed.alias("removed"), (removed / F.col("before") * 100).alias("pct"),
        "ids_remapped",
    )


def corpus_id_conflicts(corpus: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Ids that stand for more than one text."""
    return (
        text_keys(corpus, keys)
        .groupBy(*keys, "document_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys, "document_id")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("rows"))
        .filter(F.col("texts") > 1)
    )


def resolve_id_conflicts(
    rows: DataFrame, keys: list[str] = KEYS, hot_rows: int = HOT_ROWS, id_col: str = "document_id"
) -> DataFrame:
    """One row per id: the last one in source order wins.

    Only ids and positions are shuffled. They are written once, and so are the positions that are left out: a table has
    many readers, and each would find them again from all texts.
    """
    on = [*keys, id_col]
    ids = stored(rows.select(*on, "pos"), "ids")
    last = ids.groupBy(*on).agg(F.max("pos").alias("last_pos"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    spread = F.concat(F.lit("row "), F.col("pos").cast("string"))
    known = lookup(ids, last, on, hottest(last, "n", hot_rows), spread)
    stale = stored(known.filter(F.col("pos") < F.col("last_pos")).select(*keys, "pos"), "stale")
    rows = rows.select(*keys, "pos", *[c for c in rows.columns if c not in (*keys, "pos")])
    if stale.isEmpty():
        return rows
    if dict(rows.dtypes)["pos"] in ("int", "bigint"):
        return by_position(rows, stale, keep=False, keys=keys)
    return rows.join(stale, [*keys, "pos"], "left_anti")
