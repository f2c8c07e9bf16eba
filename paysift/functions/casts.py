"""ANSI-safe casts (K1-K4). Bad text becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, IntegerType

from paysift.functions.text import ColumnOrName, col_of

# Fixed values the results depend on: the survey timestamp pattern and the
# money type.
TS_FORMAT = "M/d/yyyy H:mm:ss"
MONEY = DecimalType(38, 2)

# An integer with an optional fraction that is dropped (legacy truncating cast);
# without digits before the point it is 0.
_INT_TEXT = r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$"
_FRACTION_TEXT = r"^\s*[+-]?\.[0-9]*\s*$"


# Text that holds one of these is no number: a cast that fails costs an exception, many
# times what a cast costs, so it isn't tried. (Exponents, hexadecimal floats, NaN and Infinity have the letters left out.)
_NO_MONEY = r"[A-DF-Za-df-z$,%()/~]"
_NO_FLOAT = r"[GHJ-MOQ-SU-WZghj-moq-su-wz$,%()/~]"


def _unless(c: Column, hopeless: str) -> Column:
    return F.when((c != "") & ~c.rlike(hopeless), c)


def try_ts(c: ColumnOrName) -> Column:
    """Survey timestamp text to a timestamp; NULL when it does not parse. The
    text is read as UTC whatever the session's zone, so a time that a zone's
    clock change skips stays what it says."""
    return F.try_to_timestamp(F.concat(col_of(c), F.lit(" +00:00")), F.lit(TS_FORMAT + " XXX"))


def try_money(c: ColumnOrName) -> Column:
    """String to decimal(38,2), HALF_UP; NULL when it does not parse."""
    return _unless(col_of(c), _NO_MONEY).try_cast(MONEY)


def try_float(c: ColumnOrName) -> Column:
    return _unless(col_of(c), _NO_FLOAT).try_cast(FloatType())


def try_int_trunc(c: ColumnOrName) -> Column:
    """String to int that truncates a fraction (``2.5`` -> 2) like a non-ANSI
    cast did; anything else that is not an integer gives NULL."""
    digits = F.regexp_extract(col_of(c), _INT_TEXT, 1)  # '' where it doesn't match
    whole = F.when(digits != "", digits).try_cast(IntegerType())
    return F.when(col_of(c).rlike(_FRACTION_TEXT), F.lit(0)).otherwise(whole)


_KINDS = {
    "timestamp": try_ts,
    "money": try_money,
    "float": try_float,
    "int": try_int_trunc,
    "string": col_of,
}


def to_kind(c: ColumnOrName, kind: str) -> Column:
    """Cast cleaned text to one of the target kinds used by the form specs."""
    return _KINDS[kind](c)
