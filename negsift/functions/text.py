"""String expressions: trimming, title merging, tokens, names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters trimmed at both ends of a text: Unicode's white space, and the separators 1c-1f.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# Separators between tokens.
TOKEN_SPLIT = r"[ \t\n\r\f]+"


def strip_space(text: Column) -> Column:
    """Looks at the ends of a text only; a pattern would go through all of it, and this is done wherever texts are read."""
    return F.btrim(text, F.lit(SPACES))


def title_and_text(title: Column, text: Column) -> Column:
    """Title, a space and the text; the text as it is when there is no title."""
    title = F.coalesce(title.cast("string"), F.lit(""))
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(title == "", text).otherwise(strip_space(F.concat(title, F.lit(" "), text)))


def text_key(text: Column) -> Column:
    """A 256-bit digest that stands for a text in groupings.

    Equal texts have equal keys, and grouping on 32 bytes instead of the text
    keeps document bodies out of the shuffle.
    """
    return F.unhex(F.sha2(text, 256))


def short_name(dataset: Column) -> Column:
    """Last path part of a dataset name in lower case."""
    return F.lower(F.substring_index(dataset, "/", -1))
