"""Common table expressions shared by the checking SQL."""

PLACES = 9

# --- source tables ---------------------------------------------------------------

CHAT_ROWS = """
turns AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM conversations),
chat_rows AS (
  SELECT 'chat/Turns' AS dataset, 'mixed' AS lang, u.pos, u.text AS instruction, a.text AS response
  FROM turns u LEFT JOIN turns a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' AND u.role = 'user'),
chat AS (
  SELECT *, 'q_mixed_' || pos AS query_id, 'd_mixed_' || pos AS document_id
  FROM chat_rows WHERE instruction <> '' AND response <> '')"""

BEIR = """
corpus AS (
  SELECT 'beir/Bench' AS dataset, 'mixed' AS lang, doc_id::VARCHAR AS document_id,
         CASE WHEN lang <> 'en' AND source <> ''
              THEN regexp_replace(regexp_replace(source || ' ' || text, '^[\\s\\x0b]+', ''), '[\\s\\x0b]+$', '')
              ELSE text END AS document,
         doc_id AS pos
  FROM documents WHERE text <> '' OR (lang <> 'en' AND source <> '')),
queries AS (
  SELECT 'beir/Bench' AS dataset, 'mixed' AS lang, item_id::VARCHAR AS query_id, text AS query, item_id AS pos
  FROM benchmark WHERE text <> ''),
judged AS (
  SELECT b.item_id, d.doc_id, 1 - coalesce(l.toxic, 0) AS score
  FROM benchmark b JOIN documents d ON contains(d.text, b.text) LEFT JOIN labels l ON l.doc_id = d.doc_id),
qrels AS (
  SELECT 'beir/Bench' AS dataset, 'mixed' AS lang, item_id::VARCHAR AS query_id, doc_id::VARCHAR AS document_id,
         item_id * 1000000000 + doc_id AS pos
  FROM judged WHERE score > 0)"""


def buckets(name: str, source: str, id_col: str, text: str, dim: int, limit: int = 0) -> str:
    words = f"list_filter(string_split_regex(lower({text}), '[ \\t\\n\\r\\f]+'), lambda w: w <> '')"
    if limit:
        words = f"list_slice({words}, 1, {limit})"
    return f"""
{name} AS (
  SELECT {id_col}, ('0x' || substr(md5(w), 1, 4))::BIGINT % {dim} AS bucket, count(*) AS n
  FROM (SELECT {id_col}, unnest({words}) AS w FROM {source}) GROUP BY ALL)"""


def ranked(scores: str, k: int, order: str = "DESC") -> str:
    return f"""
hits AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, document_id) AS rank FROM {scores})
  WHERE rank <= {k})"""


def text_hits(k: int, dim: int) -> str:
    """Hashed-text cosine of every query and document, and the best k."""
    return (
        BEIR
        + ","
        + buckets("db", "corpus", "document_id", "document", dim)
        + ","
        + buckets("qb", "queries", "query_id", "query", dim)
        + f""",
dn AS (SELECT document_id, sqrt(sum(n * n)) AS norm FROM db GROUP BY ALL),
qn AS (SELECT query_id, sqrt(sum(n * n)) AS norm FROM qb GROUP BY ALL),
dots AS (SELECT query_id, document_id, sum(qb.n * db.n) AS dot FROM qb JOIN db USING (bucket) GROUP BY ALL),
scored AS (
  SELECT q.query_id, d.document_id, round(coalesce(dot / (qn.norm * dn.norm), 0), {PLACES}) AS score
  FROM queries q CROSS JOIN corpus d
  LEFT JOIN qn ON qn.query_id = q.query_id LEFT JOIN dn ON dn.document_id = d.document_id
  LEFT JOIN dots ON dots.query_id = q.query_id AND dots.document_id = d.document_id),"""
        + ranked("scored", k)
    )


# --- vectors ---------------------------------------------------------------------

METRIC = {
    "cosine": "list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[])",
    "ip": "list_inner_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[])",
    "l2": "list_distance(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) ** 2",
}

VEC_QRELS = """
qrels AS (
  SELECT 'q' || vec_id AS query_id, 'd' || vec_id AS document_id FROM embeddings
  UNION
  SELECT 'q' || e.vec_id, 'd' || f.first_id FROM embeddings e
  JOIN (SELECT label, min(vec_id) AS first_id FROM embeddings GROUP BY label) f ON f.label = e.label),
queries AS (SELECT 'q' || vec_id AS query_id FROM embeddings)"""


def vec_hits(k: int, metric: str = "cosine") -> str:
    return (
        f"""
scored AS (
  SELECT 'q' || q.vec_id AS query_id, 'd' || d.vec_id AS document_id, round({METRIC[metric]}, {PLACES}) AS score
  FROM embeddings q CROSS JOIN embeddings d),"""
        + ranked("scored", k, "ASC" if metric == "l2" else "DESC")
    )


# --- mining ----------------------------------------------------------------------


def mined(num_negatives: int) -> str:
    """``entries``, the long mining result, from ``queries``, ``hits`` and ``qrels``."""
    return f"""
labelled AS (
  SELECT coalesce(h.query_id, r.query_id) AS query_id, coalesce(h.document_id, r.document_id) AS document_id,
         h.score, h.rank, r.query_id IS NOT NULL AS is_pos
  FROM hits h FULL JOIN (SELECT DISTINCT query_id, document_id FROM qrels
                         WHERE query_id IN (SELECT query_id FROM queries)) r
    ON r.query_id = h.query_id AND r.document_id = h.document_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY
              CASE WHEN is_pos AND rank IS NOT NULL THEN 0 WHEN is_pos THEN 1 ELSE 2 END, rank, document_id) AS place,
         count(*) FILTER (is_pos) OVER (PARTITION BY query_id) AS positives
  FROM labelled),
entries AS (
  SELECT query_id, document_id, place, coalesce(score, -1.0) AS score, is_pos, rank IS NOT NULL AS retrieved, positives
  FROM placed WHERE positives > 0 AND place - positives <= {num_negatives})"""


VALID = """
valid AS (
  SELECT query_id, count(*) AS entries, max(score) FILTER (place = 1) AS positive_score
  FROM entries GROUP BY query_id HAVING count(*) >= 2 AND max(score) FILTER (place = 1) > 0)"""


def contrastive(num_negatives: int, chosen: str = "valid", drop_positives: bool = False) -> str:
    also = "AND NOT e.is_pos" if drop_positives else ""
    return f"""
long AS (
  SELECT e.query_id, -1 AS ordinal, e.document_id, e.score FROM entries e JOIN {chosen} USING (query_id) WHERE place = 1
  UNION ALL
  SELECT * FROM (
    SELECT e.query_id, row_number() OVER (PARTITION BY e.query_id ORDER BY place) - 1 AS ordinal, e.document_id, e.score
    FROM entries e JOIN {chosen} USING (query_id)
    WHERE place > 1 AND e.document_id IN (SELECT document_id FROM corpus) {also})
  WHERE ordinal < {num_negatives})"""


def whole(value: str) -> str:
    """A score of nine places as an integer: lists of these print alike everywhere."""
    return f"round({value} * 1000000000)::BIGINT"
