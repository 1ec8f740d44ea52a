"""Encoding and retrieval: exact, by cells, codes and buckets, late interaction."""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from checks import sql, tables as t
from checks.catalog import query
from negsift.functions.vectors import l2_normalize as unit_vector
from negsift.operators import cells, encode, graph, index, late, lloyd, residual, rotation
from negsift.operators.retrieve import knn, recall, retrieve
from negsift.operators.scorers import Dense
from negsift.operators.topk import emitted
from negsift.schema import KEYS
from negsift.session import scratch_path, stored

K = 10


def rounded(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "document_id", "score", F.col("rank").cast("long").alias("rank"))


def hits_sql(ctes: str) -> str:
    return f"WITH {ctes} SELECT query_id, document_id, score, rank FROM hits"


# --- encoding --------------------------------------------------------------------


def _long(rows: DataFrame) -> DataFrame:
    return (
        rows.select("doc_id", F.posexplode("embedding").alias("bucket", "n"))
        .filter("n > 0")
        .select("doc_id", F.col("bucket").cast("long"), F.col("n").cast("long"))
    )


@query(f"WITH {sql.buckets('b', 'documents', 'doc_id', 'text', 256)} SELECT * FROM b")
def encode_hashed(spark, sf):
    return _long(encode.hashed_encoder(256)(t.table(spark, sf, "documents"), "text"))


@query(f"WITH {sql.buckets('b', 'documents', 'doc_id', 'text', 256, 32)} SELECT * FROM b")
def encode_truncated(spark, sf):
    """The token limit of a model, here 32 tokens."""
    return _long(encode.hashed_encoder(256, max_tokens=32)(t.table(spark, sf, "documents"), "text"))


def _word_shape(dim: int = 8):
    """A stand-in for a model: counts of word lengths."""

    def load():
        def predict(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                for word in text.split(" "):
                    out[row, len(word) % dim] += 1
            return out

        return predict

    return load


@query("""SELECT doc_id, len(w) % 8 AS bucket, count(*) AS n
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY ALL""")
def encode_model(spark, sf):
    """The plug-in for batch models."""
    return _long(encode.model_encoder(_word_shape(), batch_size=64)(t.table(spark, sf, "documents"), "text"))


@query("""SELECT doc_id, len(w) % 8 AS bucket, count(*) AS n
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY ALL""")
def encode_budget(spark, sf):
    """The same model in batches of texts of similar length."""
    return _long(encode.budget_encoder(_word_shape(), 20_000)(t.table(spark, sf, "documents"), "text"))


@query("""SELECT vec_id, i - 1 AS i, round(embedding[i]::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS x
FROM embeddings, generate_series(1, 64) g(i)""")
def l2_normalize(spark, sf):
    rows = t.table(spark, sf, "embeddings").select("vec_id", F.posexplode(unit_vector(F.col("embedding"))).alias("i", "x"))
    return rows.select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


TOKENS = """
toks AS (
  SELECT vec_id, tok, list_slice(embedding, 16 * tok + 1, 16 * tok + 16)::DOUBLE[] AS v
  FROM embeddings, generate_series(0, 3) g(tok))"""


@query(f"""WITH {TOKENS} SELECT 'd' || vec_id AS document_id, tok, i - 1 AS i, v[i] AS x FROM toks, generate_series(1, 16) g(i)""")
def token_vectors(spark, sf):
    rows = encode.token_vectors(t.vec_tokens(spark, sf).corpus, "document_id")
    return rows.select("document_id", F.col("tok").cast("long").alias("tok"), F.posexplode("v").alias("i", "x")).select(
        "document_id", "tok", F.col("i").cast("long").alias("i"), F.col("x").cast("double").alias("x")
    )


HASHED_WORD = "list_transform(range(16), lambda i: (('0x' || substr(md5(w), 2 * i + 1, 2))::BIGINT - 127.5))"


def word_sets(name: str, source: str, id_col: str, text: str) -> str:
    return f"""
{name} AS (
  SELECT DISTINCT {id_col}, w FROM (
    SELECT {id_col}, unnest(string_split_regex(lower({text}), '[ \\t\\n\\r\\f]+')) AS w FROM {source}) WHERE w <> '')"""


@query(f"""WITH {word_sets('words', 'documents', 'doc_id', 'text')},
raw AS (SELECT w, {HASHED_WORD} AS v FROM (SELECT DISTINCT w FROM words)),
unit AS (SELECT w, sqrt(list_inner_product(v, v)) AS n, v FROM raw)
SELECT doc_id, count(*) AS tokens, round(sum(v[1] / n), 3) AS first_sum, round(sum(v[16] / n), 3) AS last_sum
FROM words JOIN unit USING (w) GROUP BY doc_id""")
def encode_tokens(spark, sf):
    """Token vectors from text: how many, and the sums of their first and last numbers."""
    rows = encode.hashed_token_encoder()(t.table(spark, sf, "documents"), "text")
    total = lambda i: F.aggregate("tokens", F.lit(0.0), lambda a, v: a + v[i].cast("double"))
    return rows.filter(F.size("tokens") > 0).select(
        "doc_id", F.size("tokens").cast("long").alias("tokens"), F.round(total(0), 3).alias("first_sum"), F.round(total(15), 3).alias("last_sum")
    )


# --- exact search ----------------------------------------------------------------


def exact(spark, sf, **options) -> DataFrame:
    queries, corpus, _ = t.vec(spark, sf)
    return knn(queries, corpus, options.pop("k", K), **options)


@query(hits_sql(sql.vec_hits(K)))
def knn_cosine_topk(spark, sf):
    return rounded(exact(spark, sf))


@query(hits_sql(sql.vec_hits(K, "ip")))
def knn_ip_topk(spark, sf):
    return rounded(exact(spark, sf, metric="ip"))


@query(hits_sql(sql.vec_hits(K, "l2")))
def knn_l2_topk(spark, sf):
    return rounded(exact(spark, sf, metric="l2"))


@query(hits_sql(sql.vec_hits(K)))
def knn_blocked(spark, sf):
    """The form for query sides that do not fit a broadcast."""
    return rounded(exact(spark, sf, form="blocks", doc_block=300, query_block=200))


@query(hits_sql(sql.vec_hits(K)))
def knn_floors(spark, sf):
    """Floors found on a quarter of the corpus, then the whole corpus in small blocks."""
    return rounded(exact(spark, sf, form="blocks", doc_block=40, query_block=200, floor_rows=1, floor_share=4))


@query(f"""SELECT count(*) AS queries, {K}::BIGINT AS k, true AS bounded FROM embeddings""")
def knn_emitted(spark, sf):
    """What leaves the scoring steps stays near k rows per query and share of the floors
    (twice that is asked), also when each block holds few documents."""
    queries, corpus, _ = t.vec(spark, sf)
    sent = emitted(queries, corpus, K, Dense("cosine"), form="blocks", doc_block=20, floor_rows=1, floor_share=4)
    found = sent.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("query_id").alias("queries"))
    return found.select("queries", F.lit(K).cast("long").alias("k"), (F.col("n") <= 2 * 4 * K * F.col("queries")).alias("bounded"))


@query(hits_sql(sql.text_hits(20, 256)))
def knn_text_topk(spark, sf):
    """Texts in, hits out: hashed encoder and exact cosine."""
    queries, corpus, _ = t.beir(spark, sf)
    return rounded(retrieve(queries, corpus, 20, encode=encode.hashed_encoder(256)))


def in_languages(rows: DataFrame, id_col: str) -> DataFrame:
    """Three languages, by number."""
    return rows.withColumn("lang", F.concat(F.lit("l"), F.substring(id_col, 2, 20).cast("long") % 3))


@query(f"""WITH scored AS (
  SELECT 'l' || q.vec_id % 3 AS lang, 'q' || q.vec_id AS query_id, 'd' || d.vec_id AS document_id, round({sql.METRIC['cosine']}, {sql.PLACES}) AS score
  FROM embeddings q JOIN embeddings d ON q.vec_id % 3 = d.vec_id % 3), {sql.ranked('scored', K)}
SELECT lang, query_id, document_id, score, rank FROM hits""")
def knn_languages_topk(spark, sf):
    """Three languages in one search, each in its own corpus."""
    queries, corpus, _ = t.vec(spark, sf)
    hits = knn(in_languages(queries, "query_id"), in_languages(corpus, "document_id"), K)
    return hits.select("lang", "query_id", "document_id", "score", F.col("rank").cast("long").alias("rank"))


# --- cells -----------------------------------------------------------------------

NLIST, NPROBE = 16, 4


def label_centroids(spark, sf) -> cells.Matrices:
    """Fixed cells: the mean vector of each label, rounded. One row per label."""
    rows = t.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = rows.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    listed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("label")
    return {("vec", "mixed"): np.array([[e["x"] for e in row["v"]] for row in listed.collect()])}


FIXED_CELLS = """
means AS (SELECT label, i, round(avg(x), 6) AS x FROM (
    SELECT label, g.i, embedding[g.i]::DOUBLE AS x FROM embeddings, generate_series(1, 64) g(i)) GROUP BY ALL),
centroids AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, list(x ORDER BY i) AS c FROM means GROUP BY label),
near AS (
  SELECT e.vec_id, k.cell, row_number() OVER (PARTITION BY e.vec_id ORDER BY
    list_inner_product(list_transform(e.embedding::DOUBLE[], lambda x: x / sqrt(list_inner_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))), k.c) DESC, k.cell) AS place
  FROM embeddings e CROSS JOIN centroids k)"""


@query(f"""WITH {FIXED_CELLS},
scored AS (
  SELECT 'q' || q.vec_id AS query_id, 'd' || d.vec_id AS document_id, round({sql.METRIC['cosine']}, {sql.PLACES}) AS score
  FROM near p JOIN embeddings q ON q.vec_id = p.vec_id
  JOIN near a ON a.cell = p.cell AND a.place = 1 JOIN embeddings d ON d.vec_id = a.vec_id WHERE p.place <= 3),
{sql.ranked('scored', K)}
SELECT query_id, document_id, score, rank FROM hits""")
def ivf_topk(spark, sf):
    """Search in the three closest of a fixed set of cells."""
    queries, corpus, _ = t.vec(spark, sf)
    fixed = label_centroids(spark, sf)
    return rounded(cells.ivf_topk(queries, cells.with_cell(corpus, fixed), fixed, K, nprobe=3))


@query(hits_sql(sql.vec_hits(K)))
def ivf_all_cells(spark, sf):
    """Trained cells, all of them searched: equal to exact search."""
    return rounded(exact(spark, sf, method="ivf", nlist=NLIST, nprobe=NLIST))


@query(f"SELECT 'vec' AS dataset, 'mixed' AS lang, count(*) AS documents, true AS within FROM embeddings")
def ivf_cells(spark, sf):
    """Trained cells hold every document once, and there are as many as asked for at most."""
    corpus = t.vec(spark, sf).corpus
    sizes = cells.with_cell(corpus, cells.train_cells(corpus, NLIST)).groupBy(*KEYS, "cell").count()
    within = F.min("cell").between(0, NLIST - 1) & F.max("cell").between(0, NLIST - 1)
    return sizes.groupBy(*KEYS).agg(F.sum("count").alias("documents"), within.alias("within"))


STEPS = 2


def _steps() -> str:
    """Lloyd steps from the first four vectors of each language."""
    out = [f"""v AS (SELECT vec_id, 'l' || vec_id % 3 AS lang, embedding::DOUBLE[] AS e FROM embeddings),
c0 AS (SELECT lang, cell, e AS c FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY vec_id) - 1 AS cell FROM v) WHERE cell < 4)"""]
    for i in range(STEPS):
        out.append(f"""
a{i} AS (
  SELECT vec_id, v.lang, e, cell FROM (
    SELECT v.*, c.cell, row_number() OVER (PARTITION BY v.vec_id ORDER BY list_distance(v.e, c.c), c.cell) AS p FROM v JOIN c{i} c ON c.lang = v.lang) v
  WHERE p = 1),
c{i + 1} AS (
  SELECT lang, cell, list(x ORDER BY i) AS c
  FROM (SELECT lang, cell, i, avg(e[i]) AS x FROM a{i}, generate_series(1, 64) g(i) GROUP BY ALL) GROUP BY lang, cell)""")
    return ",".join(out)


@query(f"WITH {_steps()} SELECT lang, cell, i - 1 AS i, round(c[i], 6) AS x FROM c{STEPS}, generate_series(1, 64) g(i)")
def cells_joint(spark, sf):
    """Two turns for three languages together, from given seeds."""
    rows = in_languages(t.vec(spark, sf).corpus, "document_id").withColumn("embedding", F.col("embedding").cast("array<double>"))
    number = F.substring("document_id", 2, 20).cast("long")
    first = rows.withColumn("n", number).filter("n < 12").orderBy("n").collect()
    seeds: dict = {}
    for r in first:
        seeds.setdefault((r["dataset"], r["lang"]), []).append(r["embedding"])
    found = lloyd.lloyd(rows, {key: np.array(block) for key, block in seeds.items()}, STEPS)
    lines = [(key[1], c, i, float(x)) for key, block in found.items() for c, v in enumerate(block) for i, x in enumerate(v)]
    return spark.createDataFrame(lines, "lang string, cell long, i long, x double").withColumn("x", F.round("x", 6))


#: What a trained or random search must reach on these vectors, which are random: the cells
#: and buckets that it leaves out are as good as those it searches.
FLOORS = {"ivf": 0.35, "ivfpq": 0.5, "lsh": 0.7, "plaid": 0.5, "graph": 0.8}


def enough(kind: str) -> str:
    return f"SELECT 'vec' AS dataset, 'mixed' AS lang, count(*) * {K} AS wanted, true AS enough FROM embeddings"


def _enough(spark, sf, kind: str, hits: DataFrame, against: DataFrame | None = None) -> DataFrame:
    found = recall(hits, exact(spark, sf) if against is None else against, K)
    return found.select(*KEYS, "wanted", (F.col("recall") >= FLOORS[kind]).alias("enough"))


@query(enough("ivf"))
def ivf_recall(spark, sf):
    return _enough(spark, sf, "ivf", exact(spark, sf, method="ivf", nlist=NLIST, nprobe=NPROBE))


@query(enough("ivfpq"))
def ivfpq_recall(spark, sf):
    return _enough(spark, sf, "ivfpq", exact(spark, sf, method="ivfpq", nlist=NLIST, nprobe=NLIST, m_pq=8))


PIECES = 8  # sub-vectors of 8 numbers

FIXED_CODES = f"""
{FIXED_CELLS},
unit AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS u
  FROM embeddings),
celled AS (
  SELECT u.vec_id, n.cell, k.c, list_transform(range(64), lambda i: u.u[i + 1] - k.c[i + 1]) AS r
  FROM unit u JOIN near n ON n.vec_id = u.vec_id AND n.place = 1 JOIN centroids k ON k.cell = n.cell),
coded AS (
  SELECT * FROM (
    SELECT d.vec_id, d.cell, j, list_slice(k.c, 8 * j + 1, 8 * j + 8) AS book,
      row_number() OVER (PARTITION BY d.vec_id, j ORDER BY list_distance(list_slice(d.r, 8 * j + 1, 8 * j + 8), list_slice(k.c, 8 * j + 1, 8 * j + 8)), k.cell) AS place
    FROM celled d CROSS JOIN generate_series(0, {PIECES - 1}) g(j) CROSS JOIN centroids k)
  WHERE place = 1),
approx AS (SELECT vec_id, any_value(cell) AS cell, flatten(list(book ORDER BY j)) AS r FROM coded GROUP BY vec_id)"""


@query(f"""WITH {FIXED_CODES},
scored AS (
  SELECT 'q' || q.vec_id AS query_id, 'd' || d.vec_id AS document_id,
    round(list_inner_product(q.u, k.c) + list_inner_product(q.u, d.r), {sql.PLACES}) AS score
  FROM near p JOIN unit q ON q.vec_id = p.vec_id JOIN approx d ON d.cell = p.cell JOIN centroids k ON k.cell = p.cell WHERE p.place <= 3),
{sql.ranked('scored', K)}
SELECT query_id, document_id, score, rank FROM hits""")
def ivfpq_fixed_topk(spark, sf):
    """Codes from fixed codebooks, the slices of the fixed centroids."""
    queries, corpus, _ = t.vec(spark, sf)
    fixed = label_centroids(spark, sf)
    books = {key: np.split(block, PIECES, axis=1) for key, block in fixed.items()}
    coded = cells.with_codes(cells.residuals(cells.with_cell(corpus, fixed), fixed), books)
    return rounded(cells.ivfpq_topk(queries, coded, fixed, books, K, nprobe=3))


#: A fixed rotation: signs by the ones that two numbers have in common (a Hadamard matrix over 8).
SPIN = "list_transform(range(64), lambda j: list_sum(list_transform(range(64), lambda i: {v}[i + 1] * (1 - 2 * (bit_count((i & j)::BIGINT) % 2)))) / 8)"

FIXED_SPUN = (
    FIXED_CODES.replace("unit AS (", "plain AS (", 1)
    .replace("celled AS (", f"unit AS (SELECT vec_id, {SPIN.format(v='u')} AS u FROM plain), spun AS (SELECT cell, {SPIN.format(v='c')} AS c FROM centroids),\ncelled AS (", 1)
    .replace("JOIN centroids k ON k.cell = n.cell)", "JOIN spun k ON k.cell = n.cell)")
    .replace(f"g(j) CROSS JOIN centroids k)", "g(j) CROSS JOIN spun k)")
)


def fixed_spin() -> np.ndarray:
    return np.array([[1.0 - 2 * ((i & j).bit_count() % 2) for j in range(64)] for i in range(64)]) / 8


@query(f"""WITH {FIXED_SPUN},
coarse AS (
  SELECT q.vec_id AS qv, d.vec_id AS dv, row_number() OVER (PARTITION BY q.vec_id ORDER BY
    round(list_inner_product(q.u, k.c) + list_inner_product(q.u, d.r), {sql.PLACES}) DESC, 'd' || d.vec_id) AS place
  FROM near p JOIN unit q ON q.vec_id = p.vec_id JOIN approx d ON d.cell = p.cell JOIN spun k ON k.cell = p.cell WHERE p.place <= 3),
scored AS (
  SELECT 'q' || q.vec_id AS query_id, 'd' || d.vec_id AS document_id, round({sql.METRIC['cosine']}, {sql.PLACES}) AS score
  FROM coarse JOIN embeddings q ON q.vec_id = qv JOIN embeddings d ON d.vec_id = dv WHERE place <= {4 * K}),
{sql.ranked('scored', K)}
SELECT query_id, document_id, score, rank FROM hits""")
def opq_fixed_topk(spark, sf):
    """Codes of vectors in fixed other directions; the best 4k by code ranked by their exact scores."""
    queries, corpus, _ = t.vec(spark, sf)
    fixed, spin = label_centroids(spark, sf), {("vec", "mixed"): fixed_spin()}
    centroids = rotation.turned(fixed, spin)
    books = {key: np.split(block, PIECES, axis=1) for key, block in centroids.items()}
    rest = cells.residuals(cells.with_cell(corpus, fixed), fixed)
    coded = cells.with_codes(rotation.rotated(rest, spin), books)
    return rounded(rotation.rotated_topk(queries, corpus, (coded, centroids, books, spin), K, nprobe=3))


TABLES, BITS, FLIPS = 4, 3, 1


def fixed_planes(dim: int = 64) -> np.ndarray:
    """Signs by the first hex digit of an MD5."""
    import hashlib

    sign = lambda *at: 1.0 if hashlib.md5(":".join(map(str, at)).encode()).hexdigest()[0] in "01234567" else -1.0
    return np.array([[[sign(a, b, i) for i in range(dim)] for b in range(BITS)] for a in range(TABLES)])


FIXED_BUCKETS = f"""
planes AS (
  SELECT a AS tbl, b AS bit, list(CASE WHEN substr(md5(a || ':' || b || ':' || i), 1, 1) < '8' THEN 1.0 ELSE -1.0 END::DOUBLE ORDER BY i) AS p
  FROM generate_series(0, {TABLES - 1}) x(a), generate_series(0, {BITS - 1}) y(b), generate_series(0, 63) z(i) GROUP BY a, b),
sides AS (
  SELECT e.vec_id, tbl, bit, list_inner_product(list_transform(e.embedding::DOUBLE[],
    lambda x: x / sqrt(list_inner_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))), p) AS side FROM embeddings e CROSS JOIN planes),
nearest AS (SELECT *, row_number() OVER (PARTITION BY vec_id, tbl ORDER BY abs(side), bit) AS place FROM sides),
own AS (
  SELECT vec_id, tbl, sum(CASE WHEN side > 0 THEN 1 << bit ELSE 0 END)::BIGINT AS bucket FROM sides GROUP BY ALL),
probed AS (
  SELECT vec_id, tbl, bucket FROM own
  UNION ALL SELECT o.vec_id, o.tbl, xor(o.bucket, (1 << n.bit)::BIGINT) FROM own o JOIN nearest n ON n.vec_id = o.vec_id AND n.tbl = o.tbl AND n.place <= {FLIPS}),
pairs AS (SELECT DISTINCT p.vec_id AS qv, o.vec_id AS dv FROM probed p JOIN own o ON o.tbl = p.tbl AND o.bucket = p.bucket)"""


@query(f"""WITH {FIXED_BUCKETS},
scored AS (
  SELECT 'q' || q.vec_id AS query_id, 'd' || d.vec_id AS document_id, round({sql.METRIC['cosine']}, {sql.PLACES}) AS score
  FROM pairs JOIN embeddings q ON q.vec_id = qv JOIN embeddings d ON d.vec_id = dv),
{sql.ranked('scored', K)}
SELECT query_id, document_id, score, rank FROM hits""")
def lsh_fixed_topk(spark, sf):
    """Buckets of fixed planes: a pair is scored once, however many tables it meets in."""
    queries, corpus, _ = t.vec(spark, sf)
    return rounded(cells.lsh_topk(queries, corpus, K, flips=FLIPS, planes=fixed_planes(), center={("vec", "mixed"): np.zeros(64)}))


@query(f"""WITH {FIXED_BUCKETS},
together AS (SELECT count(*) AS met FROM probed p JOIN own o ON o.tbl = p.tbl AND o.bucket = p.bucket),
rows AS (SELECT count(*) AS n FROM embeddings)
SELECT 'vec' AS dataset, 'mixed' AS lang, met, n AS queries, n AS documents, met / (n * n) AS share FROM together, rows""")
def lsh_share(spark, sf):
    """Pairs that the fixed buckets bring together, as a share of all."""
    queries, corpus, _ = t.vec(spark, sf)
    return cells.scored_share(*cells.bucketed(queries, corpus, fixed_planes(), {("vec", "mixed"): np.zeros(64)}, "cosine", FLIPS))


def right(hits: str = str(K)) -> str:
    return f"SELECT 'q' || vec_id AS query_id, {hits}::BIGINT AS hits, true AS exact FROM embeddings"


def _right(found: DataFrame, scores: DataFrame) -> DataFrame:
    """Per query: hits, and whether each has the score that exact search gives the pair."""
    pair = ["query_id", "document_id"]
    both = found.select(*pair, "score").join(scores.select(*pair, F.col("score").alias("whole")), pair, "left")
    return both.groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"), F.bool_and(F.col("score").eqNullSafe(F.col("whole"))).alias("exact"))


def _right_pairs(spark, sf, found: DataFrame) -> DataFrame:
    """The same for cosine, from the vectors of the pairs that were found."""
    queries, corpus, _ = t.vec(spark, sf)
    q, d = queries.select("query_id", F.col("embedding").alias("q")), corpus.select("document_id", F.col("embedding").alias("d"))
    pairs = found.select("query_id", "document_id").join(q, "query_id").join(d, "document_id")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("q", "d") / F.sqrt(dot("q", "q") * dot("d", "d"))
    return _right(found, pairs.select("query_id", "document_id", F.round(cosine, 9).alias("score")))


@query(right())
def lsh_topk(spark, sf):
    """Random planes: k hits per query, each with its exact score."""
    return _right_pairs(spark, sf, exact(spark, sf, method="lsh"))


@query(f"SELECT 'beir/Bench' AS dataset, 'mixed' AS lang, count(*) * {K} AS wanted, true AS enough, true AS pruned FROM benchmark WHERE text <> ''")
def lsh_text_recall(spark, sf):
    """Hashed texts: half of the neighbours for three in ten of the pairs. The neighbours of a short
    item among invented prose are hardly nearer than the rest; the README has the figures."""
    encoded = encode.hashed_encoder(256)
    queries, corpus, _ = t.beir_texts(spark, sf)
    queries, corpus = stored(encoded(queries, "query"), "vectors"), stored(encoded(corpus, "document"), "vectors")
    planes, center = cells.random_planes(8, 7, 256, 42), cells.centers(corpus, "cosine")
    hits = cells.lsh_topk(queries, corpus, K, flips=3, planes=planes, center=center)
    share = cells.scored_share(*cells.bucketed(queries, corpus, planes, center, "cosine", 3)).select(*KEYS, "share")
    found = recall(hits, knn(queries, corpus, K), K).join(share, KEYS)
    return found.select(*KEYS, "wanted", (F.col("recall") >= 0.5).alias("enough"), (F.col("share") <= 0.3).alias("pruned"))


@query(enough("lsh"))
def lsh_recall(spark, sf):
    return _enough(spark, sf, "lsh", exact(spark, sf, method="lsh"))


@query(hits_sql(sql.vec_hits(K)))
def ivf_saved_roundtrip(spark, sf):
    """A saved index, read back and searched in all of its cells."""
    queries, corpus, _ = t.vec(spark, sf)
    path = scratch_path(spark, "index")
    centroids = cells.train_cells(corpus, NLIST)
    cells.save_index(cells.with_cell(corpus, centroids), centroids, path)
    celled, read, _ = cells.load_index(spark, path)
    return rounded(cells.ivf_topk(queries, celled, read, K, nprobe=NLIST))


# --- exact cells, neighbour graph ------------------------------------------------


@query(hits_sql(sql.vec_hits(K)))
def ivf_exact_topk(spark, sf):
    """Cells left out by the bounds of their rings only: equal to exact search."""
    return rounded(exact(spark, sf, method="ivf_exact", nlist=NLIST, nprobe=NPROBE))


@query(hits_sql(sql.vec_hits(K, "ip")))
def ivf_exact_ip_topk(spark, sf):
    return rounded(exact(spark, sf, metric="ip", method="ivf_exact", nlist=NLIST, nprobe=NPROBE))


@query(hits_sql(sql.vec_hits(K, "l2")))
def ivf_exact_l2_topk(spark, sf):
    return rounded(exact(spark, sf, metric="l2", method="ivf_exact", nlist=NLIST, nprobe=NPROBE))


HOPS, BEAM, WIDTH, LINKS = 3, 24, 4, 4

#: Fixed links by number: the next, the previous and two far ones.
FIXED_LINKS = """
unit AS (
  SELECT vec_id AS node, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS u
  FROM embeddings),
whole AS (SELECT count(*) AS n FROM unit),
links AS (
  SELECT DISTINCT node, unnest([(node + 1) % n, (node + n - 1) % n, (7 * node + 3) % n, (31 * node + 11) % n]) AS other FROM unit, whole)"""


def _hops() -> str:
    """The search, hop by hop: rank what was seen, follow the best not yet followed, score what is new."""
    steps = ["""seen0 AS (
  SELECT q.node AS qn, d.node AS dn, round(list_inner_product(q.u, d.u), 9) AS s, false AS f FROM unit q JOIN unit d ON d.node % 50 = 0)"""]
    for h in range(HOPS + 1):
        steps.append(f"""
ranked{h} AS (SELECT *, row_number() OVER (PARTITION BY qn ORDER BY s DESC, 'd' || dn) AS place FROM seen{h}),
beam{h} AS MATERIALIZED (
  SELECT *, place <= {BEAM} AND NOT f AND count(*) FILTER (place <= {BEAM} AND NOT f) OVER (PARTITION BY qn ORDER BY place) <= {WIDTH} AS now
  FROM ranked{h})""")
        if h < HOPS:
            steps.append(f"""
new{h} AS (
  SELECT DISTINCT qn, other AS dn FROM beam{h} JOIN links ON links.node = dn WHERE now
  EXCEPT SELECT qn, dn FROM beam{h}),
seen{h + 1} AS (
  SELECT qn, dn, s, f OR now AS f FROM beam{h}
  UNION ALL SELECT qn, dn, round(list_inner_product(q.u, d.u), 9), false FROM new{h} JOIN unit q ON q.node = qn JOIN unit d ON d.node = dn)""")
    return ",".join(steps)


def fixed_graph(spark, sf) -> graph.Graph:
    nodes = t.vec(spark, sf).corpus.withColumn("node", F.substring("document_id", 2, 20).cast("long"))
    n, node = nodes.count(), F.col("node")
    others = F.array((node + 1) % n, (node + n - 1) % n, (7 * node + 3) % n, (31 * node + 11) % n)
    links = nodes.select("node", F.array_distinct(others).alias("neighbours"))
    return graph.Graph(nodes.select(*KEYS, "node", "document_id", "embedding"), links, {}, None)


@query(f"""WITH {FIXED_LINKS}, {_hops()}
SELECT 'q' || qn AS query_id, 'd' || dn AS document_id, s AS score, place AS rank FROM beam{HOPS} WHERE place <= {K}""")
def graph_fixed_topk(spark, sf):
    """Three hops over fixed links from fixed documents, four of the best 24 followed at a time."""
    queries, corpus, _ = t.vec(spark, sf)
    fixed = fixed_graph(spark, sf)
    start = fixed.nodes.filter("node % 50 = 0").select(*KEYS, "node")
    found = graph.search_graph(queries, fixed, start, "cosine", BEAM, WIDTH, HOPS)
    return found.filter(F.col("place") <= K).select("query_id", "document_id", "score", F.col("place").cast("long").alias("rank"))


@query(f"""WITH {FIXED_LINKS},
far AS (
  SELECT l.node, other, round(greatest(2 - 2 * list_inner_product(a.u, b.u), 0), 6) AS far
  FROM links l JOIN unit a ON a.node = l.node JOIN unit b ON b.node = other WHERE l.node <> other),
back AS (
  SELECT other AS node, node AS other FROM (SELECT *, row_number() OVER (PARTITION BY other ORDER BY far, node) AS place FROM far) WHERE place <= {LINKS}),
around AS (SELECT node, other FROM far UNION SELECT node, other FROM back),
met AS (SELECT DISTINCT a.other AS node, b.other FROM around a JOIN around b ON a.node = b.node AND a.other <> b.other),
pool AS (SELECT node, other FROM met UNION SELECT node, other FROM far),
placed AS (
  SELECT pool.node, other, round(greatest(2 - 2 * list_inner_product(a.u, b.u), 0), 6) AS far,
    row_number() OVER (PARTITION BY pool.node ORDER BY list_inner_product(a.u, b.u) DESC, other) AS place
  FROM pool JOIN unit a ON a.node = pool.node JOIN unit b ON b.node = other)
SELECT node, other, far, (node, other) NOT IN (SELECT (node, other) FROM far) AS fresh FROM placed WHERE place <= {LINKS}""")
def graph_round(spark, sf):
    """One round from fixed links: neighbours of a node meet, and each keeps its four nearest."""
    fixed = fixed_graph(spark, sf)
    points = graph.placed(fixed.nodes, "cosine")
    links = fixed.links.select("node", F.explode("neighbours").alias("other")).filter("node <> other")
    of = lambda name: points.select(F.col("node").alias(name), F.col("embedding").alias(f"_{name}"))
    links = links.join(of("node"), "node").join(of("other"), "other")
    links = links.select("node", "other", graph.pair_score("l2")("_node", "_other").alias("far"), F.lit(True).alias("fresh"))
    return graph.improved(stored(links, "links"), points, LINKS).select("node", "other", F.round("far", 6).alias("far"), "fresh")


@query(right())
def graph_topk(spark, sf):
    """A graph built from the vectors: k hits per query, each with its exact score."""
    return _right_pairs(spark, sf, exact(spark, sf, method="hnsw"))


@query(enough("graph"))
def graph_recall(spark, sf):
    return _enough(spark, sf, "graph", exact(spark, sf, method="hnsw"))


# --- late interaction ------------------------------------------------------------

MAXSIM = f"""{TOKENS},
best AS (
  SELECT q.vec_id AS qv, d.vec_id AS dv, q.tok, max(list_inner_product(q.v, d.v)) AS s
  FROM toks q CROSS JOIN toks d GROUP BY ALL),
scored AS (
  SELECT 'q' || qv AS query_id, 'd' || dv AS document_id, round(sum(s ORDER BY tok), {sql.PLACES}) AS score FROM best GROUP BY qv, dv),
{sql.ranked('scored', K)}"""


@query(hits_sql(MAXSIM))
def maxsim_topk(spark, sf):
    queries, corpus, _ = t.vec_tokens(spark, sf)
    return rounded(late.maxsim_topk(queries, corpus, K))


@query(hits_sql(MAXSIM))
def plaid_full(spark, sf):
    """All token centroids probed and no pruning: equal to exact late interaction."""
    queries, corpus, _ = t.vec_tokens(spark, sf)
    return rounded(late.plaid_topk(queries, corpus, K, nlist=NLIST, nprobe=NLIST, full_scores=None))


@query(hits_sql(sql.vec_hits(K)))
def index_appended(spark, sf):
    """An index of two thirds of the vectors, the rest appended, searched in all of its cells."""
    queries, corpus, _ = t.vec(spark, sf)
    path = scratch_path(spark, "index")
    first = F.crc32("document_id") % 3 > 0
    index.build_index(corpus.filter(first), path, nlist=NLIST)
    index.append_index(corpus, path)
    return rounded(index.search_index(queries, path, K, nprobe=NLIST))


@query("SELECT 'vec' AS dataset, 'mixed' AS lang, count(*) AS documents, 2::BIGINT AS segments, true AS near FROM embeddings")
def index_drift(spark, sf):
    """What the manifest tells of two segments of one distribution: new documents lie about as far from the cells."""
    corpus, path = t.vec(spark, sf).corpus, scratch_path(spark, "index")
    first = F.crc32("document_id") % 3 > 0
    index.build_index(corpus.filter(first), path, nlist=NLIST)
    index.append_index(corpus.filter(~first), path)
    near = F.bool_and(F.col("drift").between(0.9, 1.3)).alias("near")
    return index.index_report(spark, path).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.count(F.lit(1)).alias("segments"), near)


CENTROIDS = 16
#: Fixed token centroids: words by number, hashed like words.
FIXED_TOKENS = f"""
{TOKENS},
raw AS (SELECT c, {HASHED_WORD.replace("md5(w)", "md5(c::VARCHAR)")} AS v FROM generate_series(0, {CENTROIDS - 1}) g(c)),
centroids AS (SELECT c, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM raw),
close AS (
  SELECT t.vec_id, t.tok, t.v, k.c, k.v AS cv, list_inner_product(t.v, k.v) AS s,
    row_number() OVER (PARTITION BY t.vec_id, t.tok ORDER BY list_inner_product(t.v, k.v) DESC, k.c) AS place
  FROM toks t CROSS JOIN centroids k),
codes AS (SELECT vec_id, tok, c, cv FROM close WHERE place = 1),
candidates AS (SELECT DISTINCT q.vec_id AS qv, d.vec_id AS dv FROM close q JOIN codes d ON d.c = q.c WHERE q.place <= 2),
rough AS (
  SELECT qv, dv, sum(s ORDER BY tok) AS s FROM (
    SELECT qv, dv, q.tok, max(list_inner_product(q.v, d.cv)) AS s
    FROM candidates JOIN toks q ON q.vec_id = qv JOIN codes d ON d.vec_id = dv GROUP BY ALL) GROUP BY qv, dv),
kept AS (
  SELECT qv, dv FROM (
    SELECT *, row_number() OVER (PARTITION BY qv ORDER BY round(s, {sql.PLACES}) DESC, 'd' || dv) AS place FROM rough) WHERE place <= {4 * K}),
best AS (
  SELECT qv, dv, q.tok, max(list_inner_product(q.v, d.v)) AS s
  FROM kept JOIN toks q ON q.vec_id = qv JOIN toks d ON d.vec_id = dv GROUP BY ALL),
scored AS (
  SELECT 'q' || qv AS query_id, 'd' || dv AS document_id, round(sum(s ORDER BY tok), {sql.PLACES}) AS score FROM best GROUP BY qv, dv),
{sql.ranked('scored', K)}"""


def fixed_token_centroids() -> cells.Matrices:
    import hashlib

    raw = np.array([np.frombuffer(hashlib.md5(str(c).encode()).digest(), np.uint8) - 127.5 for c in range(CENTROIDS)])
    return {("vec", "mixed"): raw / np.linalg.norm(raw, axis=1, keepdims=True)}


@query(hits_sql(FIXED_TOKENS))
def plaid_fixed_topk(spark, sf):
    """Fixed token centroids, two probed per token, the best 4k by centroid scored exactly."""
    queries, corpus, _ = t.vec_tokens(spark, sf)
    return rounded(late.plaid_topk(queries, corpus, K, nprobe=2, full_scores=4 * K, centroids=fixed_token_centroids()))


#: A fixed codec: two bits, the same cutoffs and middles in every dimension.
CUTOFFS, MIDDLES = [-0.1, 0.0, 0.1], [-0.2, -0.05, 0.05, 0.2]
READ_BACK = """
opened AS (
  SELECT vec_id, list_transform(range(1, 17), lambda i: cv[i] + CASE WHEN v[i] - cv[i] > 0.1 THEN 0.2 WHEN v[i] - cv[i] > 0 THEN 0.05
    WHEN v[i] - cv[i] > -0.1 THEN -0.05 ELSE -0.2 END) AS v FROM close WHERE place = 1),
best AS ("""


@query(hits_sql(FIXED_TOKENS.replace("best AS (", READ_BACK.strip(), 1).replace("JOIN toks d ON d.vec_id = dv GROUP", "JOIN opened d ON d.vec_id = dv GROUP")))
def plaid_residual_topk(spark, sf):
    """Two probed centroids per token, the best 4k by centroid scored by residuals of two bits."""
    queries, corpus, _ = t.vec_tokens(spark, sf)
    centroids = fixed_token_centroids()
    same = lambda values: {key: np.tile(values, (v.shape[1], 1)) for key, v in centroids.items()}
    late_index = residual.compress(corpus, residual.Codec(2, centroids, same(CUTOFFS), same(MIDDLES)))
    return rounded(residual.residual_topk(queries, late_index, K, nprobe=2, keep=4 * K))


@query(f"""WITH {word_sets('dw', 'documents', 'doc_id', 'text')}, {word_sets('qw', 'benchmark', 'item_id', 'text')},
raw AS (SELECT w, {HASHED_WORD} AS v FROM (SELECT w FROM dw UNION SELECT w FROM qw)),
unit AS (SELECT w, list_transform(v, lambda x: (x / sqrt(list_inner_product(v, v)))::FLOAT::DOUBLE) AS v FROM raw),
pairs AS (
  SELECT a.w AS qw, b.w AS dw, list_inner_product(a.v, b.v) AS s
  FROM (SELECT * FROM unit WHERE w IN (SELECT w FROM qw)) a CROSS JOIN (SELECT * FROM unit WHERE w IN (SELECT w FROM dw)) b),
best AS (SELECT pairs.qw, doc_id, max(s) AS s FROM pairs JOIN dw ON dw.w = pairs.dw GROUP BY ALL),
scored AS (
  SELECT item_id::VARCHAR AS query_id, doc_id::VARCHAR AS document_id, round(sum(s), 6) AS score
  FROM qw JOIN best ON best.qw = qw.w GROUP BY ALL),
{sql.ranked('scored', K)}
SELECT query_id, score, rank FROM hits""")
def maxsim_text_topk(spark, sf):
    """Late interaction from text: every benchmark item against every document."""
    queries, corpus, _ = t.beir_texts(spark, sf)
    hits = retrieve(queries, corpus, K, "late_interaction", encode.hashed_token_encoder(), pruned=False)
    return rounded(hits).select("query_id", F.round("score", 6).alias("score"), "rank")


@query(right())
def plaid_saved_roundtrip(spark, sf):
    """A saved index of residuals: written, appended to, read back; k hits per query, each with the score of its read-back tokens."""
    queries, corpus, _ = t.vec_tokens(spark, sf)
    path = scratch_path(spark, "index")
    index.build_index(corpus.filter(F.crc32("document_id") % 3 > 0), path, "plaid", nlist=64)
    index.append_index(corpus, path)
    found = stored(index.search_index(queries, path, K, nprobe=2), "found")
    saved = index.Saved(spark, path)
    once = saved.documents().dropDuplicates([*KEYS, "document_id"])
    return _right(found, late.exact_scores(found, queries, once, 0, residual.opened(once, saved.codec)))


@query(right())
def plaid_topk(spark, sf):
    """Trained centroids: k hits per query, each with its exact score."""
    queries, corpus, _ = t.vec_tokens(spark, sf)
    found = stored(late.plaid_topk(queries, corpus, K, nlist=64), "found")
    return _right(found, late.exact_scores(found, queries, corpus, 0))


@query(enough("plaid"))
def plaid_recall(spark, sf):
    queries, corpus, _ = t.vec_tokens(spark, sf)
    return _enough(spark, sf, "plaid", late.plaid_topk(queries, corpus, K, nlist=64), late.maxsim_topk(queries, corpus, K))
