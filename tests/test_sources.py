import json

import pytest
from pyspark.sql import functions as F

from negsift.functions.docstrings import strip_docstrings, without_docstrings
from negsift.functions.text import title_and_text
from negsift.plans.load import load_dataset
from negsift.plans.params import Dataset
from negsift.schema import KEYS
from negsift.sources.beir import beir_bundle
from negsift.sources.layout import qrels_split_or_default, read_table, subset_name
from negsift.sources.paired import paired_bundle
from negsift.sources.positions import read_with_pos
from rows import K, as_set


def test_pair_filter_keeps_gaps(spark):
    rows = spark.createDataFrame(
        [("s", "go", 0, "q", "d"), ("s", "go", 1, None, "d"), ("s", "go", 2, "", "d"), ("s", "go", 3, " ", "d"),
         ("s", "go", 4, "q", None), ("s", "go", 5, "q", ""), ("s", "go", 6, "q6", "d6")],
        K + "pos long, ask string, code string",
    )
    bundle = paired_bundle(rows, "ask", "code")
    assert as_set(bundle.queries, "query_id", "query") == {("q_go_0", "q"), ("q_go_3", " "), ("q_go_6", "q6")}
    assert as_set(bundle.corpus, "document_id") == {("d_go_0",), ("d_go_3",), ("d_go_6",)}
    assert as_set(bundle.qrels, "query_id", "document_id") == {(f"q_go_{i}", f"d_go_{i}") for i in (0, 3, 6)}


def test_title_rules(spark):
    rows = spark.createDataFrame(
        [(1, None, "t"), (2, "", " t "), (3, " ", " t\u00a0"), (4, "T", "t \n"), (5, "T", None), (6, None, None),
         (7, "\u2003T", "t\x1f")],
        "i int, title string, text string",
    )
    got = {r["i"]: r["d"] for r in rows.select("i", title_and_text(F.col("title"), F.col("text")).alias("d")).collect()}
    # A null title or text counts as empty; only a merged text is trimmed.
    assert got == {1: "t", 2: " t ", 3: "t", 4: "T t", 5: "T", 6: "", 7: "T t"}


def _beir(spark, qrel_rows, qrel_schema):
    corpus = spark.createDataFrame([("s", "x", 0, 10, "a"), ("s", "x", 1, 11, None), ("s", "x", 2, 12, "")],
                                   K + "pos long, _id int, text string")
    queries = spark.createDataFrame([("s", "x", 0, 1, "q1"), ("s", "x", 1, 2, ""), ("s", "x", 2, 3, None)],
                                    K + "pos long, _id int, text string")
    return beir_bundle(corpus, queries, spark.createDataFrame(qrel_rows, K + qrel_schema))


def test_qrels_scores(spark):
    rows = [("s", "x", i, 1, 10 + i, score) for i, score in enumerate([1.0, 0.0, -1.0, 0.5, None])]
    bundle = _beir(spark, rows, "pos long, `query-id` int, `corpus-id` int, score double")
    assert as_set(bundle.qrels, "query_id", "document_id") == {("1", "10"), ("1", "13")}
    assert as_set(bundle.corpus, "document_id", "document") == {("10", "a")}
    assert as_set(bundle.queries, "query_id") == {("1",)}


def test_qrels_without_score(spark):
    rows = [("s", "x", 0, 1, 10), ("s", "x", 1, 9, 99)]
    bundle = _beir(spark, rows, "pos long, `query-id` int, `corpus-id` int")
    assert as_set(bundle.qrels, "query_id", "document_id") == {("1", "10"), ("9", "99")}


STRIPPED = [
    ('"""m"""\nx = 1\n', "x = 1\n"),
    ('class A:\n    """c\n    d"""\n    x = 1\n', "class A:\n    x = 1\n"),
    ('class A:\n    def f(self):\n        "m"\n        return 1\n', "class A:\n    def f(self):\n        return 1\n"),
    ('async def f():\n    """a"""\n    return 1\n', "async def f():\n    return 1\n"),
    ('def f():\n    def g():\n        """in"""\n        return 1\n    return g\n', "def f():\n    def g():\n        return 1\n    return g\n"),
    ('def f(): "d"\nx = 1\n', "x = 1\n"),  # the whole line goes
    ('"""only"""', ""),
    ("x = 'not a docstring'\n", "x = 'not a docstring'\n"),
    ('def f():\n    f"""{1}"""\n    return 1\n', 'def f():\n    f"""{1}"""\n    return 1\n'),
]


@pytest.mark.parametrize("code, want", STRIPPED)
def test_docstrings(code, want):
    assert without_docstrings(code)[0] == want


@pytest.mark.parametrize("code", ['def f(:\n    """d"""\n', '"""d"""\nx = "\0"\n', "(" * 5000 + '"d"'])
def test_unparsable_stays(code):
    assert without_docstrings(code) == (code, "failed")


def test_docstrings_only_in_python(spark):
    code = 'def f():\n    "d"\n    return 1\n'
    rows = spark.createDataFrame([("python", code), ("go", code), ("python", "x = 1"), ("python", None)], "lang string, code string")
    got = rows.select("lang", strip_docstrings(F.col("code"), F.col("lang")).alias("r")).select("lang", "r.code", "r.status").collect()
    assert {tuple(r) for r in got} == {
        ("python", "def f():\n    return 1\n", "changed"), ("go", code, "skipped"), ("python", "x = 1", "skipped"),
        ("python", None, "skipped"),
    }


def test_stripped_to_empty_survives(spark):
    rows = spark.createDataFrame([("s", "python", 0, "q", '"""only"""')], K + "pos long, q string, d string")
    assert as_set(paired_bundle(rows, "q", "d", strip_docstrings=True).corpus, "document") == {("",)}


def test_subset_names():
    assert subset_name("corpus", "go", True) == "corpus_go"
    assert subset_name("corpus", "go", True, "{lang}-{config}") == "go-corpus"
    assert subset_name("corpus", "go", False) == "corpus"
    assert qrels_split_or_default("", "train") == "train"
    assert qrels_split_or_default("test", "train") == "test"


def test_positions_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 4).write.parquet(path)
    rows = read_with_pos(spark, path)
    assert sorted(r["pos"] for r in rows.collect()) == list(range(1000))
    assert rows.filter("pos <> id").count() == 0


def _store(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def test_per_language_parts(spark, tmp_path):
    root = str(tmp_path)
    for lang in ("go", "java"):
        _store(spark, f"{root}/Org/Set/{lang}-corpus/corpus", [("1", f"doc {lang}", "T")], "_id string, text string, title string")
        _store(spark, f"{root}/Org/Set/{lang}-queries/queries", [("7", f"ask {lang}")], "_id string, text string")
        _store(spark, f"{root}/Org/Set/{lang}-qrels/test", [("7", "1", 1)], "`query-id` string, `corpus-id` string, score int")
    spec = Dataset("Org/Set", ["go", "java"], layout="coir", lang_as_config=True, lang_config_format="{lang}-{config}",
                   qrels_config="qrels", qrels_split="test")
    bundle = load_dataset(spark, root, spec)
    assert as_set(bundle.corpus, "lang", "document_id", "document") == {("go", "1", "T doc go"), ("java", "1", "T doc java")}
    assert as_set(bundle.queries, *KEYS, "query") == {("Org/Set", "go", "ask go"), ("Org/Set", "java", "ask java")}
    assert as_set(bundle.qrels, "lang", "query_id", "document_id") == {("go", "7", "1"), ("java", "7", "1")}


def test_one_table_for_all_languages(spark, tmp_path):
    root = str(tmp_path)
    _store(spark, f"{root}/Set/train", [("a", "b"), (None, "c"), ("d", "e")], "q string, c string")
    bundle = load_dataset(spark, root, Dataset("Set", ["go", "php"], query_field="q", documents_field="c"))
    assert as_set(bundle.corpus, "lang", "document_id") == {(l, f"d_{l}_{i}") for l in ("go", "php") for i in (0, 2)}


def test_paired_language_parts(spark, tmp_path):
    root = str(tmp_path)
    _store(spark, f"{root}/Set/python/train", [("ask", 'def f():\n    "d"\n    return 1\n')], "q string, c string")
    _store(spark, f"{root}/Set/ruby/train", [("ask", '"d"\n')], "q string, c string")
    spec = Dataset("Set", ["python", "ruby"], query_field="q", documents_field="c", lang_as_config=True, strip_docstrings=True)
    assert as_set(load_dataset(spark, root, spec).corpus, "lang", "document") == {
        ("python", "def f():\n    return 1\n"), ("ruby", '"d"\n'),
    }


def test_json_and_csv(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text("\n".join(json.dumps({"q": f"q{i}", "d": 'a "b"\nc', "pos": i}) for i in range(3)))
    rows = read_table(spark, str(path), "json", pos_field="pos")
    assert rows.count() == 3 and dict(rows.dtypes)["pos"] == "bigint"
    out = str(tmp_path / "csv")
    rows.write.option("header", True).option("escape", '"').csv(out)
    assert as_set(read_table(spark, out, "csv", pos_field="pos"), "pos", "d") == as_set(rows, "pos", "d")
    (tmp_path / "u.json").write_text('{"q": 1}')
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "u.json"), "json", pos_field="pos")
    assert as_set(read_table(spark, str(tmp_path / "u.json"), "json"), "pos", "q") == {(0, 1)}
