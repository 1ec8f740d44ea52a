"""Encoding whole texts with a byte-level vocabulary, with spans when asked for.

Ids are those of the tokenizer file. Texts made only of characters whose classes
every Unicode version agrees on (see ``_COMMON``) are encoded from the same
vocabulary as ranks, which is five times as fast; all others, and texts that hold
a special string which is to be one token, by the tokenizer file itself. The tests
hold both ways against each other.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

#: Texts with anything else take the slower way.
_COMMON = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f\u2010-\u2027\u20ac]*")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=4)
def encoder(paths: tuple[str, str] | None = None, specials: bool = True) -> "Encoder":
    """One per Python worker. ``paths``: the tokenizer file, and its vocabulary as ranks."""
    return Encoder(*(paths or default_paths()), specials)


class Encoder:
    """``specials``: strings of special tokens inside a text are these tokens, else plain text."""

    def __init__(self, path: str, ranks_path: str, specials: bool):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = not specials
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        added = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items()}
        self.special_strings = list(added) if specials else []
        self.widths = np.zeros(max([*ranks.values(), *added.values()]) + 1, np.int64)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)
        for token, rank in added.items():
            self.widths[rank] = len(token.encode())

    def ids(self, text: str) -> np.ndarray:
        if _COMMON.fullmatch(text) and not any(s in text for s in self.special_strings):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each token its first character and the one after its last."""
        ids = self.ids(text)
        return ids, *self.places(ids, text)

    def places(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character, and the one after the last, of each token of ``text``.

        A character cut into several tokens is in the span of each of them.
        """
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        if text.isascii():
            return ends - widths, ends
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return character[ends - widths], character[ends - 1] + 1
