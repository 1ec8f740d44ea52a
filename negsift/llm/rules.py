"""Quality rules as a short-circuit cascade.

Each rule is a Column expression that is true where it rejects a text. On a random sample the
cascade measures what a rule costs and how much it rejects, and then asks the rules in
order of rejections per cost: a text is spared all rules after the first that rejects
it. The order changes the work and the reported rule, never the verdict.

A null text counts as empty; it has no words and is rejected like any text that is too
short. An empty table gives an empty result, with the rules in the order given. Repeated
rows are judged each on their own. An input column called ``rejected_by`` is replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from negsift.llm.frames import SPACE, fresh, words as words_of
from negsift.session import stored

SYMBOLS = r"[#*$%&|<>]"
CAPITALS = r"[A-Z]"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
WINDOW = 3


# --- measures of a text ------------------------------------------------------------


def count_of(text: Column, pattern: str) -> Column:
    """How many characters of a text match ``pattern``."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


def word_chars(words: Column) -> Column:
    return F.char_length(F.concat_ws("", words)).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(WORD_CHARACTER))


def later_copies(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def window_places(words: Column) -> Column:
    """(hash, place) of every window of words. 64-bit hashes stand for the windows."""
    last = F.size(words) - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    one = lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("p"))
    return F.transform(places, one)


def repeated_places(in_order: Column) -> Column:
    """Places of windows that occur twice or more, from the sorted windows."""
    twice = lambda x, i: x["h"].eqNullSafe(F.get(in_order, i - 1)["h"]) | x["h"].eqNullSafe(F.get(in_order, i + 1)["h"])
    return F.sort_array(F.transform(F.filter(in_order, twice), lambda x: x["p"]))


def covered_words(places: Column) -> Column:
    """How many words lie in a window that starts at one of the sorted ``places``."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    add = lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")
    )
    return F.aggregate(places, start, add)["n"]


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` asks for it per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """:func:`covered_words` of a word list in one expression."""
    in_order = lambda own: F.sort_array(window_places(own))
    return once(words, lambda own: once(in_order(own), lambda s: covered_words(repeated_places(s))))


def measures(text: Column) -> dict[str, Column]:
    """All measures as expressions of their own; what no rule asks for is not computed."""
    words, lines = words_of(text), lines_with_words(text)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": word_chars(words),
        "n_symbols": count_of(text, SYMBOLS),
        "n_capitals": count_of(text, CAPITALS),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": later_copies(lines),
        "n_repeat_words": repeat_words(words),
    }


def with_measures(docs: DataFrame, text_col: str = "text", names: list[str] | None = None) -> DataFrame:
    """``docs`` with all measures, or those of ``names``, as columns; each step is computed once per text.

    Input columns of the same names are replaced.
    """
    text, w, s, x = F.col(text_col), fresh(docs, "_words"), fresh(docs, "_sorted"), fresh(docs, "_lines")
    rows = docs.withColumns({w: words_of(text), x: lines_with_words(text)}).withColumn(s, F.sort_array(window_places(F.col(w))))
    found = {
        "n_words": F.size(w).cast("long"),
        "word_chars": word_chars(F.col(w)),
        "n_symbols": count_of(text, SYMBOLS),
        "n_capitals": count_of(text, CAPITALS),
        "n_lines": F.size(x).cast("long"),
        "n_dup_lines": later_copies(F.col(x)),
        "n_repeat_words": covered_words(repeated_places(F.col(s))),
    }
    found = {k: v for k, v in found.items() if names is None or k in names}
    kept = [c for c in docs.columns if c.lower() not in found]
    return rows.select(*kept, *[v.alias(k) for k, v in found.items()])


# --- rules -------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the measures by name and returns a boolean Column."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]


RULES = [
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 12 * m["n_words"])),
    Rule("capitals", lambda m: 2 * m["n_capitals"] > m["word_chars"]),
]


def sample_of(docs: DataFrame, rows: int, seed: int = 42) -> DataFrame:
    """About ``rows`` random rows, each with the same chance; stored, so that all rules are timed over the same."""
    many = docs.count()
    return stored(docs.sample(min(1.0, rows / many), seed) if many else docs, "rule-sample")


def estimates(sample: DataFrame, rules: list[Rule], found: dict[str, Column]) -> list[tuple[Rule, float, float]]:
    """``(rule, seconds, share rejected)`` of each rule, run alone over the sample.

    The time is the least of three, beyond that of reading the sample. Rules that cost less than that
    time varies (the median of its three over the least) count as costing so much, so their order is that of their rejections.
    """

    def timed(value: Column) -> tuple[list[float], float]:
        ask = sample.agg(F.avg(value.cast("double")))
        share = ask.collect()[0][0]  # compiles
        seconds = []
        for _ in range(3):
            began = time.perf_counter()
            ask.collect()
            seconds.append(time.perf_counter() - began)
        return sorted(seconds), share or 0.0

    idle, _ = timed(F.length(F.concat_ws("", *[c for c, kind in sample.dtypes if kind == "string"])) >= 0)
    least = max(idle[1] - idle[0], 1e-4)
    out = []
    for rule in rules:
        seconds, share = timed(F.coalesce(rule.rejects(found), F.lit(False)))
        out.append((rule, max(seconds[0] - idle[0], least), share))
    return out


def cascade(
    docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text", sample_rows: int = 1000,
    found: dict[str, Column] | None = None, sample: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with ``rejected_by``: the first rule that rejects the text, or null.

    The estimate reads a ``sample`` with the columns of ``docs``, else about ``sample_rows`` rows; it only
    sets the order. ``found`` says where measures come from: columns that ``docs`` has already, or expressions. Each rule
    computes the expressions it asks for, and only for texts that come that far.
    """
    found = measures(F.col(text_col)) | (found or {})
    if sample is None:
        sample = sample_of(docs.select(text_col), sample_rows)
    ordered = sorted(estimates(sample, rules, found), key=lambda e: -e[2] / e[1])
    verdict = F.lit(None).cast("string")
    for rule, _, _ in reversed(ordered):
        verdict = F.when(rule.rejects(found), rule.name).otherwise(verdict)
    return docs.withColumn("rejected_by", verdict)


def keep_good(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text", sample_rows: int = 1000) -> DataFrame:
    """The rows that no rule rejects, with the columns of ``docs``."""
    return cascade(docs, rules, text_col, sample_rows).filter(F.col("rejected_by").isNull()).select(*docs.columns)
