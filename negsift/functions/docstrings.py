"""Docstring removal from a Python code column."""

from __future__ import annotations

import ast
import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_DOCUMENTED = (ast.Module, ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef)

#: Lines as the parser counts them; ``str.splitlines`` also ends them at form feeds, U+2028 and others.
_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")

RESULT = T.StructType([T.StructField("code", T.StringType()), T.StructField("status", T.StringType())])


def without_docstrings(code: str) -> tuple[str, str]:
    """Code without the lines its docstrings span, and parsed/changed/failed."""
    try:
        tree = ast.parse(code)
        spans = [
            (node.body[0].lineno, node.body[0].end_lineno)
            for node in ast.walk(tree)
            if isinstance(node, _DOCUMENTED) and ast.get_docstring(node, clean=False) is not None
        ]
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return code, "failed"
    if not spans:
        return code, "parsed"
    kept = _LINE.findall(code)
    for first, last in spans:
        kept[first - 1 : last] = [""] * len(kept[first - 1 : last])
    return "".join(kept), "changed"


@F.pandas_udf(RESULT)
def _strip_batch(codes: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if c is None else without_docstrings(c) for c in codes]
    return pd.DataFrame(rows, columns=["code", "status"], dtype=object)


def strip_docstrings(code: Column, lang: Column) -> Column:
    """Struct ``code, status`` for a code column.

    Only Python rows that hold a quote can carry a docstring. All other rows hand
    a null to the Python worker, so their text never leaves the JVM.
    """
    eligible = (lang == "python") & (F.contains(code, F.lit('"')) | F.contains(code, F.lit("'")))
    result = _strip_batch(F.when(eligible, code))
    return F.struct(
        F.coalesce(result["code"], code).alias("code"),
        F.coalesce(result["status"], F.lit("skipped")).alias("status"),
    )
