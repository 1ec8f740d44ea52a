"""Mining, the two output datasets, the post-hoc dedup and the full job."""

from pyspark.sql import DataFrame, functions as F

from checks import sql, tables as t
from checks.catalog import query
from checks.search_queries import K, exact
from negsift.operators import dedup, encode, formats, mine
from negsift.operators.retrieve import retrieve
from negsift.schema import KEYS
from negsift.session import scratch_path, stored

NEGATIVES = 5  # negatives kept when mining vectors

# --- vectors ---------------------------------------------------------------------

VEC = f"{sql.vec_hits(K)}, {sql.VEC_QRELS}, {sql.mined(NEGATIVES)}"


def vec_entries(spark, sf) -> DataFrame:
    queries, _, qrels = t.vec(spark, sf)
    return mine.mined_entries(queries, exact(spark, sf), qrels, NEGATIVES)


def typed(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(
        *[F.col(c).cast("long").alias(c) if c in _COUNTS else c for c in columns]
    )


_COUNTS = {"rank", "place", "ordinal", "neg_rank", "positives", "entries"}


@query(f"""WITH {sql.vec_hits(K)}, {sql.VEC_QRELS}
SELECT h.query_id, h.document_id, h.score, h.rank, r.query_id IS NOT NULL AS is_pos
FROM hits h LEFT JOIN qrels r ON r.query_id = h.query_id AND r.document_id = h.document_id""")
def hits_labeled(spark, sf):
    labelled = mine.label_hits(exact(spark, sf), t.vec(spark, sf).qrels)
    return typed(labelled, "query_id", "document_id", "score", "rank", "is_pos")


@query(f"""WITH {sql.vec_hits(K)}, {sql.VEC_QRELS}
SELECT r.query_id, r.document_id, -1.0::DOUBLE AS score FROM qrels r
WHERE NOT EXISTS (FROM hits h WHERE h.query_id = r.query_id AND h.document_id = r.document_id)""")
def positives_missing(spark, sf):
    return mine.missing_positives(exact(spark, sf), t.vec(spark, sf).qrels).drop(*KEYS)


@query(f"WITH {VEC} SELECT query_id, document_id, score, place - positives AS neg_rank FROM entries WHERE NOT is_pos")
def hard_negatives(spark, sf):
    return typed(mine.negatives(vec_entries(spark, sf)), "query_id", "document_id", "score", "neg_rank")


@query(f"""WITH {sql.vec_hits(K)}, {sql.VEC_QRELS}, {sql.mined(1000)}
SELECT query_id, document_id, score, place - positives AS neg_rank FROM entries WHERE NOT is_pos""")
def negatives_ranked(spark, sf):
    """All retrieved negatives in their order, before the cap."""
    queries, _, qrels = t.vec(spark, sf)
    entries = mine.mined_entries(queries, exact(spark, sf), qrels, 1000)
    return typed(mine.negatives(entries), "query_id", "document_id", "score", "neg_rank")


@query(f"WITH {VEC} SELECT query_id, document_id, place, score, is_pos, retrieved FROM entries")
def kd_long(spark, sf):
    return typed(vec_entries(spark, sf), "query_id", "document_id", "place", "score", "is_pos", "retrieved")


@query(f"""WITH {sql.vec_hits(K, 'l2')}, {sql.VEC_QRELS}, {sql.mined(NEGATIVES)}
SELECT query_id, document_id, place, score, is_pos, retrieved FROM entries""")
def kd_long_l2(spark, sf):
    """Squared distances: the nearest negatives are kept."""
    queries, _, qrels = t.vec(spark, sf)
    entries = mine.mined_entries(queries, exact(spark, sf, metric="l2"), qrels, NEGATIVES, metric="l2")
    return typed(entries, "query_id", "document_id", "place", "score", "is_pos", "retrieved")


HOT_QRELS = sql.VEC_QRELS.replace("),\nqueries AS", "\n  UNION SELECT 'q0', 'd' || vec_id FROM embeddings),\nqueries AS")


@query(f"""WITH {sql.vec_hits(K)}, {HOT_QRELS}, {sql.mined(NEGATIVES)}
SELECT query_id, document_id, place, score, is_pos, retrieved FROM entries""")
def kd_long_hot(spark, sf):
    """One query holds a third of all judgements; it is ranked by ranges."""
    queries, corpus, qrels = t.vec(spark, sf)
    more = corpus.select(*KEYS, F.lit("q0").alias("query_id"), "document_id", (F.col("pos") + 1_000_000_000).alias("pos"))
    entries = mine.mined_entries(queries, exact(spark, sf), qrels.unionByName(more), NEGATIVES, hot_rows=50)
    return typed(entries, "query_id", "document_id", "place", "score", "is_pos", "retrieved")


# --- texts -----------------------------------------------------------------------

TEXT_K, TEXT_NEGATIVES = 20, 10
TEXT = f"{sql.text_hits(TEXT_K, 256)}, {sql.mined(TEXT_NEGATIVES)}"


def text_hits(spark, sf) -> DataFrame:
    queries, corpus, _ = t.beir(spark, sf)
    return retrieve(queries, corpus, TEXT_K, encode=encode.hashed_encoder(256))


def text_entries(spark, sf) -> DataFrame:
    bundle = t.beir(spark, sf)
    return mine.mined_entries(bundle.queries, text_hits(spark, sf), bundle.qrels, TEXT_NEGATIVES)


@query(f"WITH {sql.BEIR} SELECT * FROM queries WHERE query_id NOT IN (SELECT query_id FROM qrels)")
def kd_skipped(spark, sf):
    bundle = t.beir(spark, sf)
    return mine.skipped_queries(bundle.queries, bundle.qrels)


@query(f"""WITH {TEXT} SELECT 'beir/Bench' AS dataset, 'mixed' AS lang, (SELECT count(*) FROM queries) AS queries,
  count(*) FILTER (place = 1) AS results, count(*) FILTER (is_pos AND NOT retrieved) AS positives_not_retrieved,
  (SELECT count(*) FROM queries) - count(*) FILTER (place = 1) AS skipped FROM entries""")
def mining_report(spark, sf):
    return mine.mining_report(t.beir(spark, sf).queries, text_entries(spark, sf))


@query(f"""WITH {TEXT} SELECT query_id, string_agg(document_id, ',' ORDER BY place) AS document_ids,
  string_agg({sql.whole('score')}::VARCHAR, ',' ORDER BY place) AS scores, 'mixed' AS split FROM entries GROUP BY query_id""")
def kd_scores(spark, sf):
    scores = formats.kd_scores(text_entries(spark, sf))
    whole = F.transform("scores", lambda s: F.round(s * 1_000_000_000).cast("long").cast("string"))
    return scores.select(
        "query_id", F.array_join("document_ids", ",").alias("document_ids"), F.array_join(whole, ",").alias("scores"), "split"
    )


@query(f"WITH {TEXT} SELECT dataset, lang, query_id, query, 'mixed' AS split, pos FROM queries WHERE query_id IN (SELECT query_id FROM entries)")
def kd_queries(spark, sf):
    return formats.kd_queries(t.beir(spark, sf).queries, text_entries(spark, sf))


@query(f"WITH {TEXT} SELECT dataset, lang, document_id, document, 'mixed' AS split, pos FROM corpus WHERE document_id IN (SELECT document_id FROM entries)")
def kd_documents(spark, sf):
    return formats.kd_documents(t.beir(spark, sf).corpus, text_entries(spark, sf))


@query(f"WITH {TEXT}, {sql.VALID} SELECT query_id, entries, positive_score FROM valid")
def contrastive_valid(spark, sf):
    return typed(formats.valid_results(text_entries(spark, sf)), "query_id", "entries", "positive_score")


def text_long(spark, sf, **options) -> DataFrame:
    entries = stored(text_entries(spark, sf), "entries")
    return formats.contrastive_long(entries, t.beir(spark, sf).corpus, options.pop("n", 5), **options)


LONG_COLUMNS = "l.query_id, l.ordinal, l.document_id, c.document, l.score"
LONG = f"{TEXT}, {sql.VALID}, {sql.contrastive(5)}"


def _long(rows: DataFrame) -> DataFrame:
    return typed(rows, "query_id", "ordinal", "document_id", "document", "score")


@query(f"WITH {LONG} SELECT {LONG_COLUMNS} FROM long l JOIN corpus c USING (document_id)")
def contrastive_long(spark, sf):
    return _long(text_long(spark, sf))


@query(f"""WITH {TEXT}, {sql.VALID}, {sql.contrastive(5, drop_positives=True)}
SELECT {LONG_COLUMNS} FROM long l JOIN corpus c USING (document_id)""")
def contrastive_dropped(spark, sf):
    """Further positives left out instead of counted as negatives."""
    return _long(text_long(spark, sf, extra_positives=formats.DROP))


WIDE_COLUMNS = ", ".join(
    f"coalesce(max(c.document) FILTER (l.ordinal = {i}), '') AS negative_{i}, "
    f"coalesce(max(l.score) FILTER (l.ordinal = {i}), 0.0) AS negative_{i}_score"
    for i in range(12)
)


@query(f"""WITH {TEXT}, {sql.VALID}, {sql.contrastive(12)}
SELECT l.query_id, any_value(q.query) AS query, max(c.document) FILTER (l.ordinal = -1) AS positive,
  max(l.score) FILTER (l.ordinal = -1) AS positive_score, {WIDE_COLUMNS}
FROM long l JOIN corpus c USING (document_id) JOIN queries q ON q.query_id = l.query_id GROUP BY l.query_id""")
def contrastive_wide(spark, sf):
    """Twelve negatives per row where mining kept ten: the last ones are padded."""
    wide = formats.contrastive_wide(text_long(spark, sf, n=12), t.beir(spark, sf).queries, 12)
    return wide.drop(*KEYS)


@query(f"""WITH {LONG}, pos AS (SELECT query_id, score AS positive_score FROM long WHERE ordinal = -1)
SELECT {LONG_COLUMNS} FROM long l JOIN corpus c USING (document_id) JOIN pos p ON p.query_id = l.query_id
WHERE l.ordinal = -1 OR l.score <= 0.95 * p.positive_score""")
def contrastive_threshold(spark, sf):
    return _long(formats.threshold(text_long(spark, sf), 0.95))


CHOSEN = "chosen AS (SELECT query_id FROM valid ORDER BY md5('42:' || query_id), query_id LIMIT 10)"


@query(f"""WITH {TEXT}, {sql.VALID}, {CHOSEN}, {sql.contrastive(5, 'chosen')}
SELECT {LONG_COLUMNS} FROM long l JOIN corpus c USING (document_id)""")
def contrastive_sample(spark, sf):
    return _long(text_long(spark, sf, limit=10))


# --- post-hoc dedup --------------------------------------------------------------

DOCS = """
docs AS (SELECT * FROM corpus WHERE document_id IN (SELECT document_id FROM entries)),
firsts AS (SELECT document, arg_min(document_id, pos) AS canonical_id, min(pos) AS pos FROM docs GROUP BY document),
id_map AS (SELECT d.document_id, f.canonical_id FROM docs d JOIN firsts f USING (document))"""
CANON = """
canon AS (SELECT query_id, coalesce(canonical_id, document_id) AS document_id, min(place) AS p, arg_min(score, place) AS score
          FROM entries LEFT JOIN id_map USING (document_id) GROUP BY ALL)"""
KD = f"{TEXT}, {DOCS}"


def kd_tables(spark, sf):
    """A KD dataset mined without corpus dedup, so that its lists hold copies."""
    entries = stored(text_entries(spark, sf), "entries")
    return formats.kd_documents(t.beir(spark, sf).corpus, entries), formats.kd_scores(entries)


@query(f"WITH {KD} SELECT canonical_id AS document_id, document, 'mixed' AS split, pos FROM firsts")
def kd_dedup_documents(spark, sf):
    documents, _ = kd_tables(spark, sf)
    return dedup.dedup_corpus(documents).drop(*KEYS)


@query(f"""WITH {KD}, {CANON}
SELECT query_id, document_id, row_number() OVER (PARTITION BY query_id ORDER BY p) AS place, score FROM canon""")
def scores_remapped(spark, sf):
    documents, scores = kd_tables(spark, sf)
    remapped = dedup.remap_scores(scores, dedup.id_map(documents))
    return typed(formats.entries_of(remapped), "query_id", "document_id", "place", "score")


# --- the full job ----------------------------------------------------------------

CHAT_DATASET, BEIR_DATASET = "chat/Turns", "beir/Bench"
JOB_NEGATIVES = 3


def store_datasets(spark, sf) -> str:
    """Both layouts as stored datasets."""
    root = scratch_path(spark, "datasets")
    drop = lambda rows: rows.drop(*KEYS)
    drop(t.chat_rows(spark, sf)).write.parquet(f"{root}/{CHAT_DATASET}/train")
    drop(t.beir_corpus_rows(spark, sf)).write.parquet(f"{root}/{BEIR_DATASET}/corpus/corpus")
    drop(t.beir_query_rows(spark, sf)).write.parquet(f"{root}/{BEIR_DATASET}/queries/queries")
    drop(t.beir_qrel_rows(spark, sf)).write.parquet(f"{root}/{BEIR_DATASET}/default/train")
    return root


def job(spark, sf, kind="both", **output):
    """Run the job on both datasets; returns its folder and report."""
    from negsift.plans.job import run_job
    from negsift.plans.params import Dataset, Mining, Output

    datasets = [
        Dataset(CHAT_DATASET, ["mixed"], query_field="instruction", documents_field="response", pos_field="pos"),
        Dataset(BEIR_DATASET, ["mixed"], layout="coir", pos_field="pos"),
    ]
    out = output.pop("out", None) or scratch_path(spark, "mined")
    mining = Mining(top_k=TEXT_K, num_negatives=TEXT_NEGATIVES, encode=encode.hashed_encoder(256), retriever=output.pop("retriever", retrieve))
    target = Output(out, kind, name="demo", max_per_query=JOB_NEGATIVES, **output)
    return out, run_job(spark, store_datasets(spark, sf), datasets, mining, target)


CHAT_TEXT = f"""{sql.CHAT_ROWS},
corpus AS (SELECT document_id, response AS document, pos FROM chat),
queries AS (SELECT query_id, instruction AS query, pos FROM chat),
qrels AS (SELECT query_id, document_id FROM chat),
{sql.text_hits(TEXT_K, 256).replace(sql.BEIR + ",", "", 1)}, {sql.mined(TEXT_NEGATIVES)}"""


def of_both(select: str, *ctes: str) -> str:
    """The same SELECT over what is mined from either dataset, called ``{name}`` in it."""
    parts = []
    for name, config, mined in ((CHAT_DATASET, "mixed", CHAT_TEXT), (BEIR_DATASET, "bench-mixed", TEXT)):
        parts.append(f"SELECT * FROM (WITH {', '.join([mined, *ctes])} {select.format(name=name, config=config)})")
    return " UNION ALL ".join(parts)


@query(of_both("""SELECT '{name}' AS dataset, 'mixed' AS lang, (SELECT count(*) FROM queries) AS queries_available,
  (SELECT count(*) FROM queries) AS queries, (SELECT count(DISTINCT query_id) FROM entries) AS results,
  (SELECT count(*) FROM entries WHERE is_pos AND NOT retrieved) AS positives_not_retrieved,
  (SELECT count(*) FROM queries) - (SELECT count(DISTINCT query_id) FROM entries) AS skipped,
  (SELECT count(*) FROM valid) AS valid, 'written' AS status""", sql.VALID))
def job_report(spark, sf):
    """Two datasets in one run."""
    return job(spark, sf)[1]


@query(of_both("SELECT '{name}' AS dataset, query_id, document_id, place, score FROM entries"))
def job_kd_scores(spark, sf):
    """KD scores read back from the written job."""
    out, _ = job(spark, sf, "kd")
    return typed(formats.entries_of(spark.read.parquet(f"{out}/kd/scores")), "dataset", "query_id", "document_id", "place", "score")


class _FailsFor:
    """Retrieval that fails for one dataset as long as ``dataset`` names it, and counts its calls."""

    def __init__(self, dataset: str):
        self.dataset, self.asked = dataset, []

    def __call__(self, queries, corpus, *args, **options):
        names = [r["dataset"] for r in queries.select("dataset").distinct().collect()]
        self.asked += names
        if self.dataset in names:
            raise RuntimeError(f"{self.dataset} is out of order")
        return retrieve(queries, corpus, *args, **options)


@query(of_both("SELECT '{name}' AS dataset, query_id, document_id, place, score FROM entries"))
def job_resumed(spark, sf):
    """A run that fails at its second dataset, and is started again: the first one is not mined twice."""
    search = _FailsFor(BEIR_DATASET)
    out = scratch_path(spark, "mined")
    step = {"retriever": search, "out": out, "datasets_per_step": 1, "resume": True}
    try:
        job(spark, sf, "kd", **step)
    except RuntimeError:
        search.dataset = ""
    report = job(spark, sf, "kd", **step)[1]
    if search.asked != [CHAT_DATASET, BEIR_DATASET, BEIR_DATASET] or report.count() != 2:
        raise ValueError(f"mined {search.asked}")
    return typed(formats.entries_of(spark.read.parquet(f"{out}/kd/scores")), "dataset", "query_id", "document_id", "place", "score")


def wide_columns(n: int) -> str:
    return ", ".join(
        f"coalesce(max(c.document) FILTER (l.ordinal = {i}), '') AS negative_{i}, "
        f"coalesce(max(l.score) FILTER (l.ordinal = {i}), 0.0) AS negative_{i}_score"
        for i in range(n)
    )


PUBLISHED_WIDE = f"""SELECT '{{config}}' AS config, any_value(q.query) AS query, max(c.document) FILTER (l.ordinal = -1) AS positive,
  max(l.score) FILTER (l.ordinal = -1) AS positive_score, {wide_columns(JOB_NEGATIVES)}
FROM long l JOIN corpus c USING (document_id) JOIN queries q ON q.query_id = l.query_id GROUP BY l.query_id"""


def published(spark, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/demo").drop(*KEYS)


@query(of_both(PUBLISHED_WIDE, sql.VALID, sql.contrastive(JOB_NEGATIVES)))
def job_contrastive(spark, sf):
    """Contrastive rows of both datasets from the published layout."""
    return published(spark, job(spark, sf)[0])


@query(of_both(PUBLISHED_WIDE, sql.VALID, sql.contrastive(JOB_NEGATIVES)))
def job_contrastive_only(spark, sf):
    """The same without a KD dataset beside it."""
    return published(spark, job(spark, sf, "contrastive")[0])


NEAR = f"""{sql.contrastive(JOB_NEGATIVES).replace("long AS", "whole AS", 1)},
far AS (
  SELECT w.* FROM whole w JOIN (SELECT query_id, score AS positive_score FROM whole WHERE ordinal = -1) p USING (query_id)
  WHERE w.ordinal = -1 OR w.score <= 0.95 * p.positive_score),
long AS (
  SELECT query_id, document_id, score,
    CASE WHEN ordinal = -1 THEN -1 ELSE row_number() OVER (PARTITION BY query_id, ordinal = -1 ORDER BY ordinal) - 1 END AS ordinal
  FROM far)"""


@query(of_both(PUBLISHED_WIDE, sql.VALID, NEAR))
def job_threshold(spark, sf):
    """Negatives too near their positive left out; the columns close up."""
    return published(spark, job(spark, sf, threshold=0.95)[0])


SHARED_IDS = """
hosts AS (
  SELECT page_id AS pos, regexp_replace(split_part(url, '/', 3), '^www[.]', '') AS id, url, html FROM pages WHERE url <> '' AND html <> ''),
kept AS (SELECT id, max(pos) AS pos FROM hosts GROUP BY id),
corpus AS (SELECT k.id AS document_id, h.html AS document, h.pos FROM kept k JOIN hosts h ON h.pos = k.pos),
queries AS (SELECT k.id AS query_id, h.url AS query, h.pos FROM kept k JOIN hosts h ON h.pos = k.pos),
qrels AS (SELECT query_id, query_id AS document_id FROM queries)"""
SHARED_TEXT = f"""{SHARED_IDS},
{sql.text_hits(TEXT_K, 256).replace(sql.BEIR + ",", "", 1)}, {sql.mined(TEXT_NEGATIVES)}"""


@query(f"WITH {SHARED_TEXT}, {sql.VALID}, {sql.contrastive(JOB_NEGATIVES)} {PUBLISHED_WIDE.format(config='hosts-mixed')}")
def job_contrastive_conflicts(spark, sf):
    """Pages by host: a host has several pages, and the last one counts."""
    from negsift.plans.job import run_job
    from negsift.plans.params import Dataset, Mining, Output

    root, out = scratch_path(spark, "datasets"), scratch_path(spark, "mined")
    host = F.regexp_replace(F.split_part("url", F.lit("/"), F.lit(3)), "^www[.]", "")
    pages = t.table(spark, sf, "pages").filter("url <> '' and html <> ''").withColumn("_id", host)
    pages.select("_id", F.col("html").alias("text"), F.col("page_id").alias("pos")).write.parquet(f"{root}/web/Hosts/corpus/corpus")
    pages.select("_id", F.col("url").alias("text"), F.col("page_id").alias("pos")).write.parquet(f"{root}/web/Hosts/queries/queries")
    judged = pages.groupBy("_id").agg(F.max("page_id").alias("pos"))
    judged.select(F.col("_id").alias("query-id"), F.col("_id").alias("corpus-id"), "pos").write.parquet(f"{root}/web/Hosts/default/train")
    mining = Mining(top_k=TEXT_K, num_negatives=TEXT_NEGATIVES, encode=encode.hashed_encoder(256))
    spec = Dataset("web/Hosts", ["mixed"], layout="coir", pos_field="pos")
    run_job(spark, root, [spec], mining, Output(out, name="demo", max_per_query=JOB_NEGATIVES))
    return published(spark, out)


TARGETS = ("mixed", "bench-mixed")


@query(of_both("""SELECT '{config}' AS target, CASE WHEN before > after THEN 'changed' ELSE 'no duplicates' END AS status,
  before, after, before - after AS removed, (SELECT count(*) FROM id_map WHERE document_id <> canonical_id) AS ids_remapped
FROM (SELECT count(*) AS before, count(DISTINCT document) AS after FROM docs)""", DOCS)
+ " UNION ALL SELECT 'absent-mixed', 'failed', NULL, NULL, NULL, NULL")
def posthoc_report(spark, sf):
    """Post-hoc dedup of two published datasets, next to a target that is absent."""
    from negsift.plans.posthoc import dedup_published

    out, _ = job(spark, sf, "kd")
    report = dedup_published(spark, f"{out}/demo_kd", scratch_path(spark, "deduped"), (*TARGETS, "absent-mixed"))
    return report.select("target", "status", "before", "after", "removed", "ids_remapped")


@query(of_both("""SELECT 'documents_{config}' AS config, f.canonical_id AS document_id, f.document, 'mixed' AS split FROM firsts f
WHERE (SELECT count(*) FROM docs) > (SELECT count(*) FROM firsts)""", DOCS))
def posthoc_documents(spark, sf):
    """The documents that the post-hoc dedup wrote."""
    return _deduped(spark, sf).filter(F.col("config").startswith("documents_")).select("config", "document_id", "document", "split")


@query(of_both("""SELECT 'scores_{config}' AS config, query_id, document_id,
  row_number() OVER (PARTITION BY query_id ORDER BY p) AS place, score
FROM canon WHERE (SELECT count(*) FROM docs) > (SELECT count(*) FROM firsts)""", DOCS, CANON))
def posthoc_scores(spark, sf):
    """The score lists that the post-hoc dedup wrote."""
    scores = _deduped(spark, sf).filter(F.col("config").startswith("scores_"))
    entries = scores.select("config", "query_id", F.posexplode(F.arrays_zip("document_ids", "scores")).alias("i", "e"))
    return entries.select(
        "config", "query_id", F.col("e.document_ids").alias("document_id"), (F.col("i") + 1).cast("long").alias("place"),
        F.col("e.scores").alias("score"),
    )


def _deduped(spark, sf) -> DataFrame:
    from negsift.plans.posthoc import dedup_published

    out, _ = job(spark, sf, "kd")
    written = scratch_path(spark, "deduped")
    dedup_published(spark, f"{out}/demo_kd", written, TARGETS)
    return spark.read.option("mergeSchema", True).parquet(written)
