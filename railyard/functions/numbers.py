"""Number parsing with the exact acceptance rules of the feeds' consumers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard.functions.text import strip

# A cast also takes "1d", "1f" and hexadecimal floats, and does not take "1_000".  Only
# text with one of these letters is matched against the full pattern.
_SUSPECT = "[dDfFxX_]"
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (
    rf"^\s*(?:[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|[+-]?(?i:inf|infinity))\s*$"
)


def _number_text(c: Column) -> Column:
    """The text as it may be cast to a number, null when it must not be.

    Blank text is sorted out first: a failing cast to double costs a Java exception, and the
    patterns need not look at it.
    """
    checked = F.when(~c.rlike(_SUSPECT), c).when(
        c.rlike(_NUMBER), F.replace(c, F.lit("_"), F.lit(""))
    )
    return F.when(c != "", checked)


def safe_float(c: Column) -> Column:
    """Parse a double; null when the text is not a number."""
    return _number_text(c).try_cast("double")


def safe_int(c: Column) -> Column:
    """Parse as a double and cut towards zero; NaN and infinities are null.

    Up to 15 digits a double is exact, so plain whole numbers are cast directly.
    """
    whole = F.when((c != "") & (F.length(c) <= 15), c.try_cast("bigint"))
    return F.coalesce(whole, safe_float(c).try_cast("bigint"))


def safe_decimal(c: Column, precision: int = 38, scale: int = 2) -> Column:
    """Parse a decimal and round half to even."""
    exact = _number_text(c).try_cast("decimal(38,18)")
    return F.bround(exact, scale).try_cast(f"decimal({precision},{scale})")


def parse_percent(c: Column) -> Column:
    """ "-6.1%" -> -6.1."""
    return safe_float(strip(F.rtrim(c, F.lit("%"))))


def strip_thousands(c: Column) -> Column:
    """ "1,761,694" -> "1761694"."""
    return F.replace(c, F.lit(","), F.lit(""))
