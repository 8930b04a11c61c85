"""Text helpers: names, composite keys, matching, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(*parts: Column) -> Column:
    """Parts joined by a space; NULL if any part is NULL."""
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(" "), part]
    return F.concat(*spaced)


def composite_text(*parts: Column, pad_last: int = 0) -> Column:
    """Display key ``a_b``. ``pad_last`` zero-pads a shorter last part and never cuts a longer one.

    Joins use the typed columns, not this text.
    """
    texts = [p.cast("string") for p in parts]
    if pad_last:
        last = texts[-1]
        texts[-1] = F.when(F.length(last) < pad_last, F.lpad(last, pad_last, "0")).otherwise(last)
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit("_"), text]
    return F.concat(*spaced)


def contains_ci(c: Column, needle: str) -> Column:
    """Literal, case-insensitive containment; NULL text does not contain anything."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def text_or(c: Column, default: str) -> Column:
    """The value as text, or ``default`` where it is NULL."""
    return F.coalesce(c.cast("string"), F.lit(default))
