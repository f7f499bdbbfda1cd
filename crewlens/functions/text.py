"""Text functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def utrim(text: Column) -> Column:
    """Strip every kind of Unicode blank from both ends; plain ``trim`` knows U+0020 only."""
    return F.trim(text, F.lit(WHITE_SPACE))


def clean_text(text: Column) -> Column:
    """Turn each character other than ASCII letters, digits and colons into a blank."""
    return F.regexp_replace(text, "[^0-9:a-zA-Z]", " ")


def labelled(label: str, text: Column, default: str | None = None) -> Column:
    """``label: text``. NULL text gives the default, or NULL when there is none."""
    if default is not None:
        text = F.coalesce(text, F.lit(default))
    return F.concat(F.lit(f"{label}: "), text)


def join_text(items: Column, sep: str = ", ") -> Column:
    """Join the items of an array, skipping NULL items; a NULL array gives ''."""
    return F.coalesce(F.array_join(items, sep), F.lit(""))


def labelled_list(
    parts: Sequence[tuple[str, Column]],
    *,
    default: str | None = None,
    sep: str = " | ",
    empty: str = "-",
) -> Column:
    """Labelled parts in one string. NULL parts are skipped; with no part left it is ``empty``."""
    if default is not None:
        # No part can be NULL: one flat concatenation, which keeps the generated code short.
        pieces = []
        for i, (label, value) in enumerate(parts):
            pieces += [F.lit(f"{sep if i else ''}{label}: "), F.coalesce(value, F.lit(default))]
        return F.concat(*pieces)
    # concat_ws skips NULLs itself, so no array has to be built and filtered.
    text = F.concat_ws(sep, *[labelled(label, value) for label, value in parts])
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(empty))
