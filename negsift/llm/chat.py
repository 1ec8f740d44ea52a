"""Chat formatting with a loss mask that is aligned by offsets.

A turn is rendered as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line
end. Where a text holds ``<|``, a backslash goes between the two characters, one more if
there are some already; so no text can hold a control string, and reading back takes one
backslash out. In roles line ends and backslashes are escaped too.

A conversation is rendered whole and encoded once. The spans of its assistant texts
and of its tokens are both sorted: binary search finds the tokens that meet a text, these
are under the loss mask, and the spans kept with them say which of their characters are.

Turns go by ``turn``, then role and text. A null text or role counts as empty; a null
``conv_id`` is a conversation of its own. Conversations are streamed through the sorted
partitions; one beyond ``PART`` characters goes out in parts that are cut between
turns, where no token can cross (a part ends in a line end and the next begins with a
control string). So a task's memory is bounded by a part and one turn, also for a
conversation that holds a third of all rows. Repeated rows are turns of their own. An
empty table gives an empty result. Columns other than the four take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from negsift.llm.tokens import encoder
from negsift.session import stored

START, STOP = "<|im_start|>", "<|im_end|>"
PART = 1 << 20
TRAINED = "assistant"
_BATCH = 1 << 20  # characters per output batch


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the spans of the texts to learn from."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == TRAINED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, STOP, "\n"]
        at += len(head) + len(body) + len(STOP) + 1
    return "".join(out), spans


def parse(text: str) -> list[tuple[str, str, int]]:
    """Role, text as it stands (still escaped) and its place, of every turn."""
    turns, at = [], 0
    while at < len(text):
        line = text.index("\n", at)
        stop = text.index(STOP, line + 1)
        turns.append((unescape_role(text[at + len(START) : line]), text[line + 1 : stop], line + 1))
        at = stop + len(STOP) + 1
    return turns


def align(spans: list[tuple[int, int]], first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The mask over tokens ``[first, last)``, and the characters of each span that they hold."""
    mask, held = np.zeros(len(first), bool), []
    for start, end in spans:
        lo, hi = np.searchsorted(last, start, side="right"), np.searchsorted(first, end, side="left")
        if start < end and lo < hi:
            mask[lo:hi] = True
            held.append((max(start, int(first[lo])), min(end, int(last[hi - 1]))))
    return mask, held


def format_conversations(turns: DataFrame, paths=None, part_chars: int = PART) -> DataFrame:
    """``conv_id, part, text, ids, loss_mask, loss_starts, loss_ends``; most conversations are one part.

    ``loss_starts`` and ``loss_ends`` are character spans in ``text``.
    """
    kind = dict(turns.dtypes)["conv_id"]
    schema = (
        f"conv_id {kind}, part int, text string, ids array<int>, loss_mask array<boolean>, "
        "loss_starts array<int>, loss_ends array<int>"
    )
    names = [c.strip().split()[0] for c in schema.split(", ")]
    types = [pa.int32(), pa.string(), *[pa.list_(t) for t in (pa.int32(), pa.bool_(), pa.int32(), pa.int32())]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(paths, False)
        out: list[tuple] = []
        now, part, held, size, started, kept, id_type = None, 0, [], 0, False, 0, None

        def finish() -> None:
            nonlocal part, held, size, kept
            text, spans = render(held)
            ids, first, last = coder.spans(text)
            mask, inside = align(spans, first, last)
            out.append((now, part, text, ids.astype(np.int32), mask, [a for a, _ in inside], [b for _, b in inside]))
            kept += len(text)
            part, held, size = part + 1, [], 0

        def batch_of() -> pa.RecordBatch:
            nonlocal out, kept
            columns = list(zip(*out)) or [[]] * 7
            arrays = [pa.array(columns[0], id_type), *[pa.array(c, t) for c, t in zip(columns[1:], types)]]
            out, kept = [], 0
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for row in zip(*(batch.column(i) for i in (0, 1, 2))):
                conv, role, text = (value.as_py() for value in row)
                if started and conv != now:
                    finish()
                    part = 0
                elif size > part_chars:
                    finish()
                now, started = conv, True
                held.append((role or "", text or ""))
                size += len(held[-1][1])
                if kept > _BATCH:
                    yield batch_of()
        if started:
            finish()
            yield batch_of()

    ordered = turns.select("conv_id", "role", "text", "turn").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, schema)


def read_back(formatted: DataFrame, paths=None) -> DataFrame:
    """What the formatted parts say, a row per conversation.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``: turns
    are read from the text alone, the loss text from the mask, its spans and the ids.
    """
    kind = dict(formatted.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [c.strip().split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(paths, False)
        out, now, state, id_type = [], None, None, None

        def row() -> tuple:
            return (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 6
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for values in zip(*batch.columns):  # one part at a time, its lists as arrays
                r = {c: v.as_py() if c in ("conv_id", "text") else v.values.to_numpy(zero_copy_only=False) for c, v in zip(batch.schema.names, values)}
                if state is None or r["conv_id"] != now:
                    if state is not None:
                        out.append(row())
                    now, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _ in parse(r["text"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{unescape(text)}\n".encode())
                for piece in masked(r, coder):
                    plain = unescape(piece)
                    state[2] += len(plain)
                    state[3].update(plain.encode())
                state[4] += len(r["text"])
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        if state is not None:
            out.append(row())
            yield batch_of(out)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.select("conv_id", "text", "ids", "loss_mask", "loss_starts", "loss_ends").mapInArrow(run, schema)


def masked(part: dict, coder) -> Iterator[str]:
    """The characters of each loss span that lie in a token under the mask."""
    first, last = coder.places(np.asarray(part["ids"], np.int64), part["text"])
    mask, size = np.asarray(part["loss_mask"], bool), len(part["text"]) + 1
    change = np.bincount(first[mask], minlength=size) - np.bincount(last[mask], minlength=size)
    learned = np.cumsum(change)[:-1] > 0
    for a, b in zip(part["loss_starts"], part["loss_ends"]):
        if learned[a:b].all():
            yield part["text"][a:b]
        else:
            yield "".join(c for c, keep in zip(part["text"][a:b], learned[a:b]) if keep)


def round_trip(turns: DataFrame, paths=None) -> DataFrame:
    """Formats all conversations, writes them, and reads them back."""
    return read_back(stored(format_conversations(turns, paths), "formatted"), paths)
