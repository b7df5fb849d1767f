"""Text rules: trimming, fallbacks, labels and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard.constants import PY_WHITESPACE


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not only blanks.

    Text of printable ASCII, the normal case, takes the much faster plain trim.
    """
    return F.when(c.rlike("[^ -~]"), F.btrim(c, F.lit(PY_WHITESPACE))).otherwise(F.trim(c))


def truthy(c: Column) -> Column:
    """Neither null nor the empty string."""
    return c.isNotNull() & (c != "")


def first_not_null(*cs: Column) -> Column:
    """First value that is present; zero and the empty string are values."""
    return F.coalesce(*cs)


def first_truthy(*cs: Column) -> Column:
    """First non-empty value, else whatever the last column holds."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs[:-1]], cs[-1])


def blank_to_null(c: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def extract_unit(c: Column) -> Column:
    """Unit in the closing parenthesis of a label ("Speed (mph)" -> "mph")."""
    inner = F.substring_index(c, "(", 1)
    inner = F.substr(c, F.length(inner) + F.lit(2))
    inner = strip(F.rtrim(inner, F.lit(")")))
    labelled = F.contains(c, F.lit("(")) & F.endswith(strip(c), F.lit(")")) & (inner != "")
    return F.when(labelled, F.lower(inner)).otherwise(F.lit("unknown"))


def slug_metric(c: Column) -> Column:
    """Label without its unit, lower case, blanks as underscores."""
    label = F.when(F.contains(c, F.lit("(")), strip(F.substring_index(c, "(", 1))).otherwise(c)
    return F.replace(F.lower(label), F.lit(" "), F.lit("_"))


def format_period(c: Column) -> Column:
    """Four characters "MMYY" become "MM/YY"; anything else is kept, null is ''."""
    text = F.coalesce(c, F.lit(""))
    return F.when(
        F.length(text) == 4, F.concat_ws("/", F.substring(text, 1, 2), F.substring(text, 3, 2))
    ).otherwise(text)


def join_nonblank(*cs: Column) -> Column:
    """Comma-joined non-blank values, null when every value is blank."""
    return F.nullif(F.concat_ws(",", *[blank_to_null(c) for c in cs]), F.lit(""))


def place_label(city: Column, state: Column) -> Column:
    """ "City, ST", or the city alone when there is no state."""
    return F.when(truthy(state), F.concat_ws(", ", city, state)).otherwise(city)


def raw_json(*cs: Column | str) -> Column:
    """The original record as JSON text; absent fields are left out."""
    return F.to_json(F.struct(*cs))


def view_tag(c: Column) -> Column:
    """Basename of a member, without extension, up to its first underscore."""
    base = F.element_at(F.split(c, "/"), -1)
    stem = F.regexp_replace(base, r"\.[^.]*$", "")
    return F.substring_index(stem, "_", 1)
