"""Sources, cleaning, dedup, sampling and load reports."""

from pyspark.sql import functions as F

from checks import sql, tables as t
from checks.catalog import query
from negsift.functions.docstrings import strip_docstrings
from negsift.functions.text import title_and_text
from negsift.operators import dedup, sample
from negsift.operators.reports import docstring_report as docstring_counts, load_report as load_counts
from negsift.plans.load import load_dataset
from negsift.plans.params import Dataset
from negsift.schema import KEYS
from negsift.session import scratch_path
from negsift.sources.beir import beir_corpus as read_corpus, beir_qrels as read_qrels, beir_queries as read_queries
from negsift.sources.layout import config_name, fan_out, read_table
from negsift.sources.paired import paired_bundle, valid_pairs


def chat(spark, sf):
    return paired_bundle(t.chat_rows(spark, sf), "instruction", "response")


# --- paired rows -----------------------------------------------------------------


@query(f"WITH {sql.CHAT_ROWS} SELECT dataset, lang, query_id, instruction AS query, pos FROM chat")
def paired_queries(spark, sf):
    return chat(spark, sf).queries


@query(f"WITH {sql.CHAT_ROWS} SELECT dataset, lang, document_id, response AS document, pos FROM chat")
def paired_corpus(spark, sf):
    return chat(spark, sf).corpus


@query(f"WITH {sql.CHAT_ROWS} SELECT dataset, lang, query_id, document_id, pos FROM chat")
def paired_qrels(spark, sf):
    return chat(spark, sf).qrels


@query(f"WITH {sql.CHAT_ROWS} SELECT pos, instruction AS query, response AS document FROM chat")
def paired_valid(spark, sf):
    return valid_pairs(t.chat_rows(spark, sf), "instruction", "response").select("pos", "query", "document")


@query(f"WITH {sql.CHAT_ROWS} SELECT query_id, document_id, pos FROM chat")
def paired_ids(spark, sf):
    """Ids count all source rows, so the dropped turns leave gaps."""
    return valid_pairs(t.chat_rows(spark, sf), "instruction", "response").select("query_id", "document_id", "pos")


@query(f"WITH {sql.CHAT_ROWS} SELECT dataset, lang, document_id, response AS document, pos FROM chat")
def paired_csv(spark, sf):
    """From CSV files without a position column, line ends inside quotes and all; ids count their rows."""
    path = scratch_path(spark, "csv")
    rows = t.chat_rows(spark, sf).orderBy("pos").select("instruction", "response")
    writer = rows.write.options(header=True, escape=chr(34), ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.csv(f"{path}/chat/Turns/train")
    spec = Dataset("chat/Turns", ["mixed"], format="csv", query_field="instruction", documents_field="response")
    return load_dataset(spark, path, spec).corpus


# --- three tables ----------------------------------------------------------------


@query(f"WITH {sql.BEIR} SELECT * FROM corpus")
def beir_corpus(spark, sf):
    return read_corpus(t.beir_corpus_rows(spark, sf))


@query(f"WITH {sql.BEIR} SELECT * FROM corpus")
def beir_jsonl(spark, sf):
    """From JSON lines without a position column, in files that are read in small splits."""
    path, rows = scratch_path(spark, "json"), t.beir_corpus_rows(spark, sf)
    rows.orderBy("pos").drop("pos", *KEYS).write.json(path)
    return read_corpus(t.bundle_columns(read_table(spark, path, "json"), "beir/Bench", "mixed"))


@query(f"WITH {sql.BEIR} SELECT * FROM queries")
def beir_queries(spark, sf):
    return read_queries(t.beir_query_rows(spark, sf))


@query(f"WITH {sql.BEIR} SELECT * FROM qrels")
def beir_qrels(spark, sf):
    return read_qrels(t.beir_qrel_rows(spark, sf))


@query("""SELECT page_id, CASE WHEN url = '' THEN html
  ELSE regexp_replace(regexp_replace(url || ' ' || html, '^[\\s\\x0b]+', ''), '[\\s\\x0b]+$', '') END AS document FROM pages""")
def beir_title_text(spark, sf):
    pages = t.table(spark, sf, "pages")
    return pages.select("page_id", title_and_text(F.col("url"), F.col("html")).alias("document"))


LANGS = ["de", "en", "es", "fr"]


@query("""SELECT 'docs' AS dataset, l.lang, 'd_' || l.lang || '_' || doc_id AS document_id, doc_id AS pos
FROM documents CROSS JOIN (VALUES ('de'), ('en'), ('es'), ('fr')) l(lang)""")
def lang_fanout(spark, sf):
    rows = t.table(spark, sf, "documents").select(F.lit("docs").alias("dataset"), F.col("doc_id").alias("pos"))
    fanned = fan_out(rows, LANGS)
    return fanned.select(
        "dataset", "lang", F.concat_ws("_", F.lit("d"), "lang", F.col("pos").cast("string")).alias("document_id"), "pos"
    )


@query("""SELECT DISTINCT 'Org/Docs' AS dataset, lang, 'docs-' || lang AS coir_name, lang AS paired_name FROM documents""")
def config_names(spark, sf):
    rows = t.bundle_columns(t.table(spark, sf, "documents"), "Org/Docs", F.col("lang")).select(*KEYS).distinct()
    return rows.select(
        *KEYS,
        config_name("coir", F.col("dataset"), F.col("lang")).alias("coir_name"),
        config_name("paired", F.col("dataset"), F.col("lang")).alias("paired_name"),
    )


# --- docstrings ------------------------------------------------------------------

CODE_LANG = "CASE WHEN lang = 'en' THEN 'python' ELSE lang END"
#: A whole text inside a string literal: backslashes and quotes are escaped, nothing is cut.
BODY = "replace(replace(text, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34))"


def code_rows(spark, sf):
    """Documents as code: the text is the docstring and, once more, a value. Texts
    of the source src0 are left unclosed, so that those rows do not parse."""
    body = F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    quotes = F.lit('"""')
    unclosed = F.when(F.col("source") == "src0", F.lit("(\n")).otherwise(F.lit(""))
    code = F.concat(
        F.lit("class D_"), F.col("doc_id"), F.lit(":\n    "), quotes, body, quotes, F.lit("\n    text = "), quotes, body,
        quotes, F.lit("\n"), unclosed,
    )
    lang = F.when(F.col("lang") == "en", "python").otherwise(F.col("lang"))
    return t.bundle_columns(t.table(spark, sf, "documents").withColumn("code", code), "code", lang)


@query(f"""SELECT doc_id, {CODE_LANG} AS lang,
  CASE WHEN lang = 'en' AND source <> 'src0'
    THEN 'class D_' || doc_id || ':' || chr(10) || '    text = \"\"\"' || {BODY} || '\"\"\"' || chr(10)
    ELSE 'class D_' || doc_id || ':' || chr(10) || '    \"\"\"' || {BODY} || '\"\"\"' || chr(10) || '    text = \"\"\"' || {BODY}
         || '\"\"\"' || chr(10) || CASE WHEN source = 'src0' THEN '(' || chr(10) ELSE '' END END AS code
FROM documents""")
def docstring_strip(spark, sf):
    return code_rows(spark, sf).select("doc_id", "lang", strip_docstrings(F.col("code"), F.col("lang"))["code"].alias("code"))


@query(f"""SELECT 'code' AS dataset, {CODE_LANG} AS lang, count(*) AS documents,
  count(*) FILTER (lang = 'en' AND source <> 'src0') AS parsed,
  count(*) FILTER (lang = 'en' AND source <> 'src0') AS changed,
  count(*) FILTER (lang = 'en' AND source = 'src0') AS failed
FROM documents GROUP BY ALL""")
def docstring_report(spark, sf):
    return docstring_counts(code_rows(spark, sf).select(*KEYS, F.col("code").alias("document")))


# --- dedup -----------------------------------------------------------------------

DUP = """
corpus AS (SELECT 'docs' AS dataset, lang, doc_id::VARCHAR AS document_id, text AS document, doc_id AS pos FROM documents),
canonical AS (
  SELECT dataset, lang, document, arg_min(document_id, pos) AS canonical_id, min(pos) AS first_pos, count(*) AS copies
  FROM corpus GROUP BY ALL),
id_map AS (
  SELECT c.dataset, c.lang, c.document_id, k.canonical_id FROM corpus c JOIN canonical k USING (dataset, lang, document)),
qrels AS (
  SELECT 'docs' AS dataset, lang, source AS query_id, doc_id::VARCHAR AS document_id, doc_id AS pos FROM documents),
remapped AS (
  SELECT q.dataset, q.lang, q.query_id, coalesce(m.canonical_id, q.document_id) AS document_id, min(q.pos) AS pos
  FROM qrels q LEFT JOIN id_map m USING (dataset, lang, document_id) GROUP BY ALL)"""


@query(f"WITH {DUP} SELECT dataset, lang, canonical_id, first_pos, copies FROM canonical")
def dedup_canonical(spark, sf):
    return dedup.canonical_ids(t.dup_corpus(spark, sf)).drop("text_key")


@query(f"WITH {DUP} SELECT * FROM id_map")
def dedup_id_map(spark, sf):
    return dedup.id_map(t.dup_corpus(spark, sf))


@query(f"WITH {DUP} SELECT dataset, lang, canonical_id AS document_id, document, first_pos AS pos FROM canonical")
def dedup_corpus(spark, sf):
    return dedup.dedup_corpus(t.dup_corpus(spark, sf))


@query(f"WITH {DUP} SELECT * FROM remapped")
def qrels_remapped(spark, sf):
    return dedup.remap_qrels(t.dup_qrels(spark, sf), dedup.id_map(t.dup_corpus(spark, sf)))


@query(f"""WITH {DUP} SELECT dataset, lang, query_id, count(*) AS n, string_agg(document_id, ',' ORDER BY pos) AS document_ids
FROM remapped GROUP BY ALL""")
def qrels_grouped(spark, sf):
    grouped = dedup.group_qrels(qrels_remapped(spark, sf))
    return grouped.select(
        *KEYS, "query_id", F.size("document_ids").cast("long").alias("n"),
        F.array_join("document_ids", ",").alias("document_ids"),
    )


@query(f"""WITH {DUP}, m AS (SELECT dataset, lang, count(*) FILTER (document_id <> canonical_id) AS ids_remapped FROM id_map GROUP BY ALL)
SELECT dataset, lang, sum(copies)::BIGINT AS before, count(*) AS after, (sum(copies) - count(*))::BIGINT AS removed,
  round((sum(copies) - count(*)) / sum(copies) * 100, 6) AS pct, any_value(ids_remapped) AS ids_remapped
FROM canonical JOIN m USING (dataset, lang) GROUP BY ALL""")
def dedup_report(spark, sf):
    return dedup.dedup_report(t.dup_corpus(spark, sf)).withColumn("pct", F.round("pct", 6))


@query("""SELECT 'pages' AS dataset, 'mixed' AS lang, document_id, count(*) AS texts, sum(n)::BIGINT AS rows FROM (
  SELECT split_part(split_part(url, '://', 2), '/', 1) AS document_id, html, count(*) AS n FROM pages GROUP BY ALL)
GROUP BY ALL HAVING count(*) > 1""")
def corpus_id_conflicts(spark, sf):
    """Host names as ids of pages: most stand for many texts."""
    return dedup.corpus_id_conflicts(host_corpus(spark, sf))


def host_corpus(spark, sf):
    host = F.substring_index(F.substring_index("url", "://", -1), "/", 1)
    rows = t.table(spark, sf, "pages").select(host.alias("document_id"), F.col("html").alias("document"), F.col("page_id").alias("pos"))
    return t.bundle_columns(rows, "pages", "mixed")


@query("""SELECT 'pages' AS dataset, 'mixed' AS lang, split_part(split_part(url, '://', 2), '/', 1) AS document_id,
  arg_max(html, page_id) AS document, max(page_id) AS pos FROM pages GROUP BY ALL""")
def corpus_id_resolved(spark, sf):
    return dedup.resolve_id_conflicts(host_corpus(spark, sf))


# --- sampling --------------------------------------------------------------------

SAMPLE = """
queries AS (SELECT 'docs' AS dataset, lang, doc_id::VARCHAR AS query_id, text AS query, doc_id AS pos FROM documents),
sampled AS (
  SELECT dataset, lang, query_id, query, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset, lang ORDER BY md5('42:' || query_id), query_id) AS place FROM queries)
  WHERE place <= 50)"""


def doc_queries(spark, sf):
    return t.dup_corpus(spark, sf).select(*KEYS, F.col("document_id").alias("query_id"), F.col("document").alias("query"), "pos")


@query(f"WITH {SAMPLE} SELECT * FROM sampled")
def query_sample(spark, sf):
    return sample.sample_queries(doc_queries(spark, sf), 50, 42)


@query(f"""WITH {SAMPLE} SELECT 'docs' AS dataset, d.lang, d.doc_id::VARCHAR AS query_id, d.source AS document_id, d.doc_id AS pos
FROM documents d JOIN sampled s ON s.lang = d.lang AND s.query_id = d.doc_id::VARCHAR""")
def qrels_sampled(spark, sf):
    judged = t.dup_qrels(spark, sf).select(
        *KEYS, F.col("document_id").alias("query_id"), F.col("query_id").alias("document_id"), "pos"
    )
    return sample.qrels_of(judged, sample.sample_queries(doc_queries(spark, sf), 50, 42))


# --- reports ---------------------------------------------------------------------


@query(f"""WITH {sql.BEIR} SELECT 'beir/Bench' AS dataset, 'mixed' AS lang, (SELECT count(*) FROM queries) AS queries,
  (SELECT count(*) FROM corpus) AS documents, (SELECT count(DISTINCT query_id) FROM qrels) AS judged_queries""")
def load_report(spark, sf):
    return load_counts(t.beir(spark, sf))
