"""Date parsing; a bad date is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard.constants import MONTH_NAMES
from railyard.functions.text import first_truthy, truthy

_DAY = r"(?!0000)(\d{4}-\d{2}-\d{2}|\d{8})"
_CLOCK = r"([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?|[0-5]\d([0-5]\d([.,]\d+)?)?)?"
_ZONE = r"(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?)"
_COMPACT = r"^(\d{4})(\d{2})(\d{2}).*$"
_ISO = f"^{_DAY}(Z|.{_CLOCK}{_ZONE}?)?$"


def _ymd(year: Column, month: Column, day: Column) -> Column:
    """A date from three whole numbers, null when the calendar has no such day."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month, day)
    return F.when(
        year.between(1, 9999) & month.between(1, 12) & day.between(1, 31), text.try_cast("date")
    )


def parse_iso_date(c: Column) -> Column:
    """Date part, as written, of an ISO 8601 date or date-time.

    A bare cast would also accept "2026", "2026-7-5" and "2026-07-25Txx".
    ISO week dates ("2026-W30-6") are not supported.
    """
    day = F.regexp_replace(F.substring(c, 1, 10), _COMPACT, "$1-$2-$3")
    return F.when(c.rlike(_ISO), day).try_cast("date")


def parse_fra_date(
    date: Column, year: Column, month: Column, accidentmonth: Column, day: Column
) -> Column:
    """The date column, else the date rebuilt from its separate parts."""
    mon = first_truthy(month, accidentmonth)
    rebuilt = _ymd(year.try_cast("int"), mon.try_cast("int"), day.try_cast("int"))
    has_parts = truthy(year) & truthy(mon) & truthy(day)
    return F.coalesce(parse_iso_date(date), F.when(has_parts, rebuilt))


def parse_dd_mon_yy(c: Column) -> Column:
    """ "21-APR-26"; two-digit years from 69 on belong to the 1900s."""
    names = "|".join(m[:3] for m in MONTH_NAMES)
    shape = rf"(?i)^( ?[1-9]|0[1-9]|[12]\d|3[01])-({names})-\d\d$"
    day = F.when(c.rlike(shape), F.try_to_date(F.ltrim(c), "d-MMM-yy"))
    return F.when(F.right(c, F.lit(2)) >= "69", F.add_months(day, -1200)).otherwise(day)


def parse_mmddyy(c: Column, reference_year: int | Column) -> Column:
    """Six digits; the century is the one nearer to the sample's year, 20yy on a tie."""
    ref = reference_year if isinstance(reference_year, Column) else F.lit(reference_year)
    mm, dd, yy = (F.substring(c, start, 2).try_cast("int") for start in (1, 3, 5))
    # |2000 + yy - ref| <= |1900 + yy - ref|, with fewer casts of the same two digits.
    year = yy + F.when(yy <= ref - 1950, 2000).otherwise(1900)
    return _ymd(year, mm, dd)


def month_end(year: Column, month: Column) -> Column:
    """Last day of a month, null for an impossible month."""
    return F.last_day(_ymd(year, month, F.lit(1)))


def year_end(year: Column) -> Column:
    """31 December of a year."""
    return _ymd(year, F.lit(12), F.lit(31))


def release_month(c: Column) -> tuple[Column, Column]:
    """(year, month) of an archive link, from its folder and file name.

    The month is the first one, in calendar order, whose full or three-letter
    English name occurs in the file name; both are null when none does.
    """
    # Fixed value: where the publisher keeps its archives.
    shape = r"(?i)transborder-raw/(\d{4})/([^/]+)\.zip$"
    name = F.lower(F.regexp_extract(c, shape, 2))
    month = F.lit(None).cast("int")
    for number, label in reversed(list(enumerate(MONTH_NAMES, start=1))):
        month = F.when(F.contains(name, F.lit(label[:3])), F.lit(number)).otherwise(month)
    month = F.when(name != "", month)
    year = F.when(month.isNotNull(), F.regexp_extract(c, shape, 1).try_cast("int"))
    return year, month


def partition_keys(
    row_date: Column, run_date: Column | None = None, grain: str = "day"
) -> list[Column]:
    """Partition columns of a row: its own date, else the run's date, else today."""
    day = F.coalesce(row_date, *([run_date] if run_date is not None else []), F.current_date())
    keys = [F.year(day).alias("p_year")]
    if grain == "day":
        keys += [F.month(day).alias("p_month"), F.dayofmonth(day).alias("p_day")]
    return keys
