"""Text to typed values. Unparsable input becomes NULL; nothing here raises on dirty data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean "missing", and the word shown in their place.
MISSING_TOKENS = ("None", "NaT", "nan", "", "<NA>", "\\N")
UNKNOWN = "unknown"

# Fixed patterns for the accepted spellings. They keep out forms that only Java accepts ("1d").
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"
ISO_DATE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"
CLOCK = r"^\s*([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})Z?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unknown_if_missing(c: Column | str) -> Column:
    """NULL and every missing-value token become ``unknown``."""
    text = _col(c).cast("string")
    return F.when(text.isNull() | text.isin(*MISSING_TOKENS), UNKNOWN).otherwise(text)


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def to_number(c: Column | str) -> Column:
    """Text to double."""
    c = _col(c)
    return F.when(c.rlike(NUMBER) | c.rlike(INFINITE), F.trim(c).try_cast("double"))


def to_integer(c: Column | str) -> Column:
    """Text to bigint; text with a fractional part is NULL, ``5.0`` is 5."""
    c = _col(c)
    number = to_number(c)
    return F.when(c.rlike(INTEGER), F.trim(c).try_cast("bigint")).when(
        number == F.floor(number), number.try_cast("bigint")
    )


def to_integer_or_zero(c: Column | str) -> Column:
    """Text to bigint, truncated toward zero; 0 where there is no number."""
    return F.coalesce(to_number(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def strict_integer(c: Column | str, name: str) -> Column:
    """An id that must be there: a NULL or a value that is no number fails the load, naming the column."""
    c = _col(c)
    whole = c.try_cast("bigint")
    missing = F.raise_error(F.concat(F.lit(f"{name} must be an integer, found "), F.coalesce(c.cast("string"), F.lit("NULL"))))
    return F.when(whole.isNotNull(), whole).otherwise(missing.cast("bigint"))


def seconds_to_millis(seconds: Column | str) -> Column:
    """Double seconds to whole milliseconds, halves to the even neighbour."""
    return F.rint(_col(seconds) * 1000).try_cast("bigint")


def duration_to_millis(c: Column | str, exact: bool = False) -> Column:
    """``m:ss.fff`` or plain seconds to milliseconds.

    By default the product of doubles is truncated, which loses one millisecond for some texts
    (``1:02.026`` gives 62025). ``exact=True`` computes with decimals instead.
    """
    c = _col(c)
    parts = F.split(c, ":")
    minutes, rest = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    if exact:
        number = lambda text: F.when(text.rlike(NUMBER), F.trim(text).try_cast("decimal(20,6)"))
    else:
        number = to_number
    whole_minutes = F.when(minutes.rlike(INTEGER), F.trim(minutes).try_cast("bigint"))
    return F.when(
        F.size(parts) == 2, ((whole_minutes * 60 + number(rest)) * 1000).try_cast("bigint")
    ).when(F.size(parts) == 1, (number(c) * 1000).try_cast("bigint"))


def to_date(c: Column | str) -> Column:
    """ISO date text, with or without a time part, to date."""
    c = _col(c)
    return F.when(c.rlike(ISO_DATE), F.regexp_extract(c, r"[0-9]{4}-[0-9]+-[0-9]+", 0).try_cast("date"))


def to_clock(c: Column | str) -> Column:
    """Time of day to ``HH:mm:ss`` text. A trailing ``Z`` is dropped."""
    c = _col(c)
    hour, minute, second = (F.regexp_extract(c, CLOCK, g).try_cast("int") for g in (1, 2, 3))
    padded = F.concat_ws(":", *(F.lpad(p.cast("string"), 2, "0") for p in (hour, minute, second)))
    return F.when((hour < 24) & (minute < 60) & (second < 60), padded)


def to_timestamp(c: Column | str) -> Column:
    """Timestamp text without zone to timestamp (microseconds)."""
    c = _col(c)
    return F.when(c.rlike(ISO_DATE), c.try_cast("timestamp_ntz"))


_FROM_TEXT = {
    "bigint": to_integer,
    "double": to_number,
    "date": to_date,
    "time": to_clock,
    "timestamp_ntz": to_timestamp,
    "boolean": lambda c: _col(c).try_cast("boolean"),
    "string": _col,
}


def typed(c: str, held: T.DataType, declared: str) -> Column:
    """Column ``c`` of stored type ``held`` as the ``declared`` type of a table."""
    col = F.col(f"`{c}`")
    if isinstance(held, T.StringType) and declared in _FROM_TEXT:
        return _FROM_TEXT[declared](col)
    if declared == "time":
        return to_clock(col.cast("string"))
    if isinstance(held, (T.DoubleType, T.FloatType)):
        col = nan_to_null(col)
    return col.try_cast(declared)
