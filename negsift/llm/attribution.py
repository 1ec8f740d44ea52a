"""Token counts by section: whole documents are encoded once, spans decide whose a token is.

A document is its fields, rendered one after the other as ``name: value`` and a line
end. Its sections are the values; a field named in ``by_line`` has a section per line.
The document is encoded as a whole, so tokens may cross from one section into the next,
or into the markup between them. Sections and tokens are both in order, so each token
finds the sections it meets by binary search on their ends and starts.

A token that meets several sections is allocated by ``rule``:

first  to the section that holds its first character that is in a section
most   to the section that holds most of its characters, the earlier one if equal
split  to each section by the share of the token's characters in it

A token that meets none belongs to the markup, section -1, which every document has. So the
counts of a document's sections add up to its tokens. A null value counts as empty; an
empty section has a row with 0 tokens. Repeated rows and ids give rows each on their
own. An empty table gives an empty result. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from negsift.llm.tokens import encoder

# The known rules.
RULES = ("first", "most", "split")
MARKUP = -1


def sections_of(values: list[tuple[str, str]], by_line: set[str]) -> tuple[str, list[str], np.ndarray, np.ndarray]:
    """The rendered document, and name, start and end of its sections."""
    out, names, starts, ends, at = [], [], [], [], 0
    for name, value in values:
        at += len(name) + 2
        lines = value.split("\n") if name in by_line else [value]
        for line in lines:
            names.append(name)
            starts.append(at)
            ends.append(at + len(line))
            at += len(line) + 1
        out.append(f"{name}: {value}\n")
    return "".join(out), names, np.array(starts, np.int64), np.array(ends, np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section; one more value at the end for the markup.

    Sections are ``[starts, ends)``, in order and apart; tokens ``[first, last)``, in order.
    """
    tokens = np.zeros(len(starts) + 1)
    # Empty sections hold no character and take no token.
    full = np.nonzero(ends > starts)[0]
    lo = np.searchsorted(ends[full], first, side="right")  # the first section ending after the token's start
    hi = np.searchsorted(starts[full], last, side="left")  # the first section starting at or after its end
    many = np.maximum(hi - lo, 0)
    tokens[-1] = (many == 0).sum()
    token = np.repeat(np.arange(len(first)), many)
    nth = np.arange(len(token)) - np.repeat(np.cumsum(many) - many, many)
    section = full[lo[token] + nth]
    shared = np.minimum(ends[section], last[token]) - np.maximum(starts[section], first[token])
    if rule == "split":
        per_token = np.bincount(token, shared, minlength=len(first))
        np.add.at(tokens, section, shared / per_token[token])
        return tokens
    order = np.lexsort((section, -shared, token)) if rule == "most" else np.lexsort((section, token))
    token, section = token[order], section[order]
    np.add.at(tokens, section[np.diff(token, prepend=-1) != 0], 1)
    return tokens


def attribute(
    docs: DataFrame, fields: list[str], id_col: str = "doc_id", by_line: set[str] = frozenset(), rule: str = "most", paths=None
) -> DataFrame:
    """``doc_id, section, field, start, end, tokens, document_tokens``: a row per section, -1 the markup."""
    if rule not in RULES:
        raise ValueError(f"unknown rule: {rule}")
    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, section int, field string, start long, end long, tokens double, document_tokens long"
    names = [c.strip().split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(paths, False)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                held = batch.slice(at, 500)
                row, section, field, start, end, tokens, total = [], [], [], [], [], [], []
                columns = [held.column(i + 1).to_pylist() for i in range(len(fields))]
                for i, values in enumerate(zip(*columns)):
                    text, own, a, b = sections_of([(n, v or "") for n, v in zip(fields, values)], by_line)
                    ids, first, last = coder.spans(text)
                    row.append(np.full(len(own) + 1, i))
                    section.append(np.append(np.arange(len(own)), MARKUP))
                    field += [*own, None]
                    start.append(np.append(a, 0))
                    end.append(np.append(b, len(text)))
                    tokens.append(allocate(a, b, first, last, rule))
                    total.append(np.full(len(own) + 1, len(ids)))
                flat = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t, from_pandas=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        held.column(0).take(flat(row, pa.int64())), flat(section, pa.int32()), pa.array(field, pa.string()),
                        flat(start, pa.int64()), flat(end, pa.int64()), flat(tokens, pa.float64()), flat(total, pa.int64()),
                    ],
                    names=names,
                )

    return docs.select(F.col(id_col).alias("_id"), *[F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(fields)]).mapInArrow(run, schema)
