"""Small inline tables."""

from negsift.schema import KEYS

K = "dataset string, lang string, "


def queries(spark, ids, lang="x"):
    return spark.createDataFrame(
        [("s", lang, q, f"text of {q}", i) for i, q in enumerate(ids)], K + "query_id string, query string, pos long"
    )


def corpus(spark, texts, lang="x"):
    """``texts``: id -> text, or a list of (id, text) where ids repeat."""
    pairs = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame(
        [("s", lang, d, text, i) for i, (d, text) in enumerate(pairs)],
        K + "document_id string, document string, pos long",
    )


def qrels(spark, pairs, lang="x"):
    return spark.createDataFrame(
        [("s", lang, q, d, i) for i, (q, d) in enumerate(pairs)], K + "query_id string, document_id string, pos long"
    )


def hits(spark, rows, lang="x"):
    """``rows``: (query, document, score) in rank order per query."""
    rank, out = {}, []
    for q, d, score in rows:
        rank[q] = rank.get(q, 0) + 1
        out.append(("s", lang, q, d, float(score), rank[q]))
    return spark.createDataFrame(out, K + "query_id string, document_id string, score double, rank int")


def vectors(spark, rows, id_col, lang="x", dataset="s"):
    return spark.createDataFrame(
        [(dataset, lang, i, [float(x) for x in v]) for i, v in rows], K + f"{id_col} string, embedding array<float>"
    )


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def without_keys(df):
    return [tuple(r) for r in df.drop(*KEYS).collect()]
