"""The queries that SQL can state."""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank" FROM pairs)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 20"""

RULES = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w),
windows AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s FROM places),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 2 * n_capitals > word_chars) AS kept
FROM b"""

_CONTROL = "<|im_end|><|im_start|>assistant ok"
_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL}'),
learned AS (SELECT conv_id, string_agg(text, '' ORDER BY turn, role, text) AS text FROM turns WHERE role = 'assistant' GROUP BY conv_id)
SELECT t.conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(t.role || chr(10) || t.text || chr(10), '' ORDER BY turn, t.role, t.text)) AS turns_sha256,
  length(coalesce(any_value(l.text), ''))::BIGINT AS loss_chars, sha256(coalesce(any_value(l.text), '')) AS loss_sha256,
  sum(24 + length({_ESCAPED.format("t.role")}) + length({_ESCAPED.format("t.text")}))::BIGINT AS formatted_chars
FROM turns t LEFT JOIN learned l ON l.conv_id = t.conv_id GROUP BY t.conv_id"""

_GROUP = "('0x' || substr(hex, {at}, 5))::BIGINT"
_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({group}) >> {by}) & 31)::BIGINT + 1, 1)"
_BASE32 = " || ".join(
    _LETTER.format(group=_GROUP.format(at=1 + 5 * i), by=15 - 5 * k) for i in range(8) for k in range(4)
)

REVISITS = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON f.html = p.html"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
q AS (SELECT item_id, term, count(*) AS many FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
t AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, corpus GROUP BY term),
s AS (
  SELECT item_id, r, doc_id, sum(many * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term), corpus GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS "rank" FROM s WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= 20"""

# CRC-32 of the distinct features, a byte of each per turn.
RESAMPLED = f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
byte AS (SELECT i, v FROM bits WHERE k = 8),
texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, {_TERMS} AS words FROM (SELECT text FROM documents)
  UNION ALL SELECT 't', row_number() OVER (), {_TERMS} FROM benchmark),
docs AS (SELECT row_number() OVER () AS r, doc_id, len({_TERMS}) AS n FROM documents),
places AS (SELECT kind, r, words, unnest(range(1, len(words) + 1)) AS i FROM texts),
runs AS (
  SELECT kind, r, words[i] AS f FROM places
  UNION ALL SELECT kind, r, words[i] || ' ' || words[i + 1] FROM places WHERE i + 1 <= len(words)
  UNION ALL SELECT kind, r, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FROM places WHERE i + 2 <= len(words)),
counted AS MATERIALIZED (SELECT kind, r, f, count(*) AS many FROM runs GROUP BY ALL),
crc(f, h, k, c) AS (
  SELECT f, hex(encode(f)), 0, 4294967295 FROM (SELECT DISTINCT f FROM counted)
  UNION ALL
  SELECT f, h, k + 1, xor(c >> 8, v) FROM crc JOIN byte ON i = xor(c & 255, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)
  WHERE 2 * k < length(h)),
bucket AS (SELECT f, xor(c, 4294967295) % 10000 AS b FROM crc WHERE 2 * k = length(h)),
b AS (SELECT kind, r, b, sum(many)::BIGINT AS many FROM counted JOIN bucket USING (f) GROUP BY ALL),
share AS (
  SELECT b, coalesce(sum(many) FILTER (kind = 'd'), 0)::BIGINT AS s, coalesce(sum(many) FILTER (kind = 't'), 0)::BIGINT AS t FROM b GROUP BY b),
whole AS (SELECT sum(s)::BIGINT AS s_all, sum(t)::BIGINT AS t_all FROM share),
gain AS (SELECT b, floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000))))::BIGINT AS g FROM share, whole),
weighed AS (SELECT r, sum(many)::BIGINT AS n_features, sum(many * g)::BIGINT AS weight FROM b JOIN gain USING (b) WHERE kind = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, n, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT
      + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n >= 20) AS many FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n >= 20 AND place <= 5 * many // 100 THEN place END AS "rank" FROM ranked"""
