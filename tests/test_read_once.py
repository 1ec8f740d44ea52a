"""What every reader of a corpus would otherwise do again."""

from pyspark.sql import functions as F

from negsift.functions.text import SPACES, strip_space, title_and_text
from negsift.operators.dedup import resolve_id_conflicts
from negsift.schema import KEYS
from tests.rows import K, as_set


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def conflicting(spark, kind="long"):
    rows = [("s", "x", "a", "first", 1), ("s", "x", "a", "last", 70_000), ("s", "x", "b", "b", 3), ("s", "x", None, "none", 4), ("s", "x", "c", "c", None)]
    rows += [("s", "x", "a", "no place", None), ("s", "y", "a", "other", 1), ("s", None, "a", "no language", 1), ("s", "x", "c", "same place", 9), ("s", "x", "c", "again", 9)]
    return spark.createDataFrame(rows, K + "document_id string, document string, pos long").withColumn("pos", F.col("pos").cast(kind))


def test_conflicts_of_ids_are_found_once(spark):
    """Readers of the rows neither group nor shuffle them again, whatever numbers the positions are."""
    want = {"last", "b", "none", "c", "no place", "other", "no language", "same place", "again"}
    for kind in ("long", "int", "string"):
        found = resolve_id_conflicts(conflicting(spark, kind))
        assert {r["document"] for r in found.collect()} == want and found.columns == [*KEYS, "pos", "document_id", "document"]
        assert "Aggregate" not in plan(found) and (kind == "string" or "SortMergeJoin" not in plan(found))


def test_rows_without_conflicts_stay_as_they_are(spark):
    rows = conflicting(spark).filter("document in ('b', 'other', 'last')")
    found = resolve_id_conflicts(rows)
    assert "Join" not in plan(found) and as_set(found, *rows.columns) == as_set(rows, *rows.columns)


def test_trimming_looks_at_the_ends(spark):
    """All white space of Unicode, and no other character, as the pattern had it."""
    odd = [chr(i) for i in (*range(0x200), 0x180E, *range(0x1FFE, 0x2070), 0x3000, 0xFEFF, 0x1F600)]
    rows = spark.createDataFrame([(c + "a" + c + " b" + c + c,) for c in [*odd, *SPACES]] + [(SPACES,), ("",), (None,)], "t string")
    space = r"[\s\x1c-\x1f]+"
    old = F.regexp_replace(F.regexp_replace("t", r"(?U)\A" + space, ""), r"(?U)" + space + r"\z", "")
    assert rows.filter(~strip_space(F.col("t")).eqNullSafe(old)).count() == 0
    assert "regexp" not in plan(rows.select(title_and_text(F.col("t"), F.col("t"))))
