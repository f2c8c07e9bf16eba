"""Generic string operators (T1-T9, F1, F6, F10, N1, N6 of the inventory)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col_of(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_letter(c: ColumnOrName) -> Column:
    """ASCII letter anywhere in the value (``é`` is not a letter here)."""
    return col_of(c).rlike("[A-Za-z]")


def has_non_digit(c: ColumnOrName) -> Column:
    """True when the value holds any character other than 0-9; blank is False."""
    return col_of(c).rlike("[^0-9]")


def before(c: ColumnOrName, delim: str) -> Column:
    """Text before the first ``delim`` (the whole value when it is absent)."""
    return F.substring_index(col_of(c), delim, 1)


def after_last(c: ColumnOrName, delim: str) -> Column:
    """Text after the last ``delim`` (the whole value when it is absent)."""
    return F.substring_index(col_of(c), delim, -1)


def delete_chars(c: ColumnOrName, chars: str) -> Column:
    return F.translate(col_of(c), chars, "")


def trim_or_default(c: ColumnOrName, default: str | None) -> Column:
    """Trim spaces, then replace NULL by ``default`` (the null-default rule)."""
    trimmed = F.trim(col_of(c))
    return trimmed if default is None else F.coalesce(trimmed, F.lit(default))


def range_bounds(c: ColumnOrName, fill_upper: bool = True) -> tuple[Column, Column]:
    """Split ``lo-hi`` on ``-``. A missing upper bound is NULL, or the lower
    bound when ``fill_upper``. Uses ``get`` so an absent index is NULL under
    ANSI mode instead of an error."""
    parts = F.split(col_of(c), "-")
    lo = F.get(parts, 0)
    hi = F.get(parts, 1)
    return lo, (F.coalesce(hi, lo) if fill_upper else hi)


def blank_if_numeric(c: ColumnOrName) -> Column:
    """Keep values holding a non-digit; all-digit and blank values become ''."""
    x = col_of(c)
    return F.when(has_non_digit(x), x).otherwise(F.lit(""))
