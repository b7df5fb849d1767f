"""Column helpers: pure Catalyst expressions, no Python runs per row."""

from railyard.functions.dates import (
    month_end,
    parse_dd_mon_yy,
    parse_fra_date,
    parse_iso_date,
    parse_mmddyy,
    partition_keys,
    release_month,
    year_end,
)
from railyard.functions.numbers import (
    parse_percent,
    safe_decimal,
    safe_float,
    safe_int,
    strip_thousands,
)
from railyard.functions.text import (
    blank_to_null,
    extract_unit,
    first_not_null,
    first_truthy,
    format_period,
    join_nonblank,
    place_label,
    raw_json,
    slug_metric,
    strip,
    truthy,
    view_tag,
)

__all__ = [
    "blank_to_null",
    "extract_unit",
    "first_not_null",
    "first_truthy",
    "format_period",
    "join_nonblank",
    "month_end",
    "parse_dd_mon_yy",
    "parse_fra_date",
    "parse_iso_date",
    "parse_mmddyy",
    "parse_percent",
    "partition_keys",
    "place_label",
    "raw_json",
    "release_month",
    "safe_decimal",
    "safe_float",
    "safe_int",
    "slug_metric",
    "strip",
    "strip_thousands",
    "truthy",
    "view_tag",
    "year_end",
]
