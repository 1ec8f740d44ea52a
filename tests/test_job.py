"""Commits: other datasets stay, a run can be resumed, positions of text formats are counted."""

import json

import pytest
from pyspark.sql import functions as F

from negsift.functions.docstrings import without_docstrings
from negsift.operators import encode
from negsift.operators.retrieve import retrieve
from negsift.plans import ledger
from negsift.plans.job import run_job
from negsift.plans.params import Dataset, Mining, Output
from negsift.sources.layout import read_table
from rows import as_set


def pairs(spark, root, name, words, lang="train"):
    rows = [(f"{w} question {i}", f"{w} answer {i}") for w in words for i in range(4)]
    spark.createDataFrame(rows, "q string, d string").coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}/{lang}")
    return Dataset(name, ["go"], query_field="q", documents_field="d")


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("lang=*") if "_staging" not in str(p))


def test_runs_keep_other_datasets(spark, tmp_path):
    root, out = str(tmp_path / "in"), tmp_path / "out"
    mining, target = Mining(6, 3, encode=encode.hashed_encoder(32)), Output(str(out), name="set", max_per_query=3)
    a, b = pairs(spark, root, "Org/A", ["red", "blue"]), pairs(spark, root, "Org/B", ["old", "new"])
    run_job(spark, root, [a], mining, target)
    had = {t: sorted(map(str, spark.read.parquet(f"{out}/{t}").collect())) for t in ("kd/scores", "kd/documents", "contrastive", "set")}
    run_job(spark, root, [b], mining, target)
    for table, rows in had.items():
        now = spark.read.parquet(f"{out}/{table}")
        assert as_set(now, "dataset") == {("Org/A",), ("Org/B",)}
        assert sorted(map(str, now.filter("dataset = 'Org/A'").collect())) == rows
    # A second run of one replaces it; a bundle that is empty by now goes.
    pairs(spark, root, "Org/A", ["green"])
    run_job(spark, root, [a], mining, target)
    texts = spark.read.parquet(f"{out}/kd/documents")
    assert {r["document"].split()[0] for r in texts.filter("dataset = 'Org/A'").collect()} == {"green"}
    assert texts.filter("dataset = 'Org/B'").count() == 8
    spark.createDataFrame([("", "")], "q string, d string").write.mode("overwrite").parquet(f"{root}/Org/A/train")
    run_job(spark, root, [a], mining, target)
    assert as_set(spark.read.parquet(f"{out}/kd/documents"), "dataset") == {("Org/B",)}
    assert not list((out / "_staging").glob("*"))


class Failing:
    def __init__(self):
        self.fails, self.asked = "Org/B", []

    def __call__(self, queries, corpus, *args, **options):
        names = {r["dataset"] for r in queries.select("dataset").distinct().collect()}
        self.asked.append(sorted(names))
        if self.fails in names:
            raise RuntimeError("out of order")
        return retrieve(queries, corpus, *args, **options)


def test_resumed(spark, tmp_path):
    root, out = str(tmp_path / "in"), tmp_path / "out"
    specs = [pairs(spark, root, n, [w]) for n, w in (("Org/A", "red"), ("Org/B", "blue"), ("Org/C", "old"))]
    search = Failing()
    mining = Mining(6, 3, encode=encode.hashed_encoder(32), retriever=search)
    target = Output(str(out), "kd", datasets_per_step=1, resume=True)
    with pytest.raises(RuntimeError):
        run_job(spark, root, specs, mining, target)
    assert as_set(ledger.finished(spark, str(out)), "dataset", "status") == {("Org/A", "written")}
    search.fails = ""
    report = run_job(spark, root, specs, mining, target)
    assert search.asked == [["Org/A"], ["Org/B"], ["Org/B"], ["Org/C"]]
    assert as_set(report, "dataset", "queries", "valid") == {(f"Org/{c}", 4, 4) for c in "ABC"}
    # All done: nothing is mined, the report is the same; other parameters count as not done.
    again = run_job(spark, root, specs, mining, target)
    assert as_set(again, *report.columns) == as_set(report, *report.columns) and len(search.asked) == 4
    run_job(spark, root, specs[:1], Mining(6, 2, encode=mining.encode, retriever=search), target)
    assert search.asked[4:] == [["Org/A"]]
    assert len(folders(out / "kd")) == 9


def test_positions_do_not_depend_on_splits(spark, tmp_path):
    """JSON lines and CSV: positions are those of the rows in the files, by name, however they are split."""
    texts = [f'row {i} "quoted"\nsecond line, and more: {"x" * (i % 40 + 1)}' for i in range(500)]
    for part, lo, hi in (("a", 0, 200), ("b", 200, 500)):
        (tmp_path / "j").mkdir(exist_ok=True)
        (tmp_path / "j" / f"{part}.json").write_text("\n".join(json.dumps({"t": x, "_id": i, "pos": "n"}) for i, x in list(enumerate(texts))[lo:hi]) + "\n")
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "n int, t string").orderBy("n")
    frame.repartitionByRange(3, "n").sortWithinPartitions("n").write.option("header", True).option("escape", '"').csv(f"{tmp_path}/c")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4k", "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = read_table(spark, f"{tmp_path}/j", "json")
            assert as_set(rows, "pos", "t") == set(enumerate(texts)) and as_set(rows, "source_pos") == {("n",)}
            assert as_set(read_table(spark, f"{tmp_path}/c", "csv"), "pos", "t") == set(enumerate(texts))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows.filter(F.col("_id") != F.col("pos")).count() == 0


@pytest.mark.parametrize("end", ["\u2028", "\u2029", "\x0c", "\x85", "\x1c", "\x0b"])
def test_lines_are_those_of_the_parser(end):
    code = f'x = "a{end}b"\ndef f():\r\n    """Gone."""\r\n    return x\n'
    got, status = without_docstrings(code)
    assert status == "changed" and got == code.replace('    """Gone."""\r\n', "")
    compile(got, "x", "exec")
