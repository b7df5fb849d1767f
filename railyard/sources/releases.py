"""Weekly-release pages and the links that lead to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.constants import RELEASE_HEADER_WORDS, RELEASE_REGIONS
from railyard.functions import strip, strip_thousands
from railyard.functions.stages import evaluate_once
from railyard.sources.feeds import unescape

# Fixed value: a count as releases print it.
_INTEGER = r"^\d[\d,]*$"
_RECORD_LINES = 6

# How a release page words its week and its last day.
WEEK = r"Week\s+(\d+),\s+(\d{4})"
ENDED = r"Ended\s+([A-Za-z]+ \d{1,2}, \d{4})"


def parse_release_pages(
    pages: DataFrame, max_pages: int | None = 4, title_lines: int | None = 8
) -> DataFrame:
    """Table rows of each release page; ``pages`` has (doc_id, page_no, text).

    A page counts when one of its first ``title_lines`` non-empty lines is a region title
    (None: any line) and week, year and end date are found.  Records are six lines each, from the first
    line after "This Week" that is followed by an integer, until the first record
    whose second line is not one.  The feed's tables stand on the first ``max_pages`` pages of a release; later
    pages repeat figures in running text (None: every page is read).
    """
    title = "^(" + "|".join(t.replace(".", r"\.") for t in RELEASE_REGIONS) + r")\d*$"
    region_of = F.create_map(*[F.lit(x) for pair in RELEASE_REGIONS.items() for x in pair])
    lines = F.filter(F.transform(F.split("text", r"\r\n|\n|\r"), strip), lambda x: x != "")
    ended = F.regexp_extract("text", ENDED, 1)
    week = WEEK
    top = F.slice("lines", 1, title_lines) if title_lines is not None else F.col("lines")
    wanted = F.lit(True) if max_pages is None else F.col("page_no").between(0, max_pages - 1)
    titled = F.get(F.filter(top, lambda x: x.rlike(title)), F.lit(0))
    split = evaluate_once(
        pages.where(wanted),
        "doc_id",
        "page_no",
        "text",
        lines.alias("lines"),
    )
    heads = (
        split.select(
            "doc_id",
            "page_no",
            "lines",
            F.try_element_at(region_of, F.regexp_extract(titled, title, 1)).alias("region"),
            F.regexp_extract("text", week, 1).alias("week_number"),
            F.regexp_extract("text", week, 2).alias("year"),
            F.try_to_date(ended, "MMMM d, yyyy").cast("string").alias("week_end_date"),
        )
        .where("region IS NOT NULL AND week_number <> '' AND week_end_date IS NOT NULL")
    )
    found = evaluate_once(heads, "*", _first_record("lines").alias("start"))
    found = found.where("start IS NOT NULL")
    count = F.greatest(F.expr("(size(lines) - start) div 6"), F.lit(0)).cast("int")
    offsets = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    record = F.transform(offsets, lambda k: _record(k))
    broken = F.array_min(
        F.transform(
            F.filter("records", lambda r: ~r["cars"].rlike(_INTEGER)), lambda r: r["n"]
        )
    )
    rows = (
        evaluate_once(found, "*", record.alias("records"))
        .withColumn("stop", broken)
        .select("*", F.explode("records").alias("r"))
        .where(F.col("stop").isNull() | (F.col("r.n") < F.col("stop")))
    )
    return rows.select(
        "doc_id",
        "page_no",
        "region",
        "week_number",
        "year",
        "week_end_date",
        F.col("r.label").alias("category"),
        strip_thousands(F.col("r.cars")).alias("this_week_cars"),
        F.col("r.yoy").alias("this_week_yoy_pct"),
        strip_thousands(F.col("r.ytd")).alias("ytd_cars"),
        strip_thousands(F.col("r.avg")).alias("ytd_avg_week_cars"),
        F.col("r.ytd_yoy").alias("ytd_yoy_pct"),
    )


def _first_record(lines: str) -> Column:
    """0-based line of the first record after the "This Week" header, or null."""
    header = F.array_position(F.transform(lines, F.lower), F.lit("this week"))

    def starts(pair: Column) -> Column:
        label = F.lower(pair["line"])
        is_header = label.isin(RELEASE_HEADER_WORDS) | label.startswith("avg/wk")
        return (pair["i"] >= header) & ~is_header & pair["next"].rlike(_INTEGER)

    pairs = F.transform(
        lines,
        lambda x, i: F.struct(
            i.alias("i"), x.alias("line"), F.get(F.col(lines), i + 1).alias("next")
        ),
    )
    return F.when(header > 0, F.get(F.filter(pairs, starts), F.lit(0))["i"])


def _record(k: Column) -> Column:
    def at(n: int) -> Column:
        return F.get(F.col("lines"), F.col("start") + k * _RECORD_LINES + n)

    names = ["label", "cars", "yoy", "ytd", "avg", "ytd_yoy"]
    return F.struct(k.alias("n"), *[at(i).alias(name) for i, name in enumerate(names)])


# Bare document URLs, then documents named in an href.
PDF_LINKS = (r"""(?i)(https?://[^\s"'<>]+\.pdf)""", r"""(?i)href="([^"]*\.pdf)\"""")
# Fixed value: monthly archives on the border-trade page.
ARCHIVE_LINKS = (r"""(?i)href="(/sites/bts\.dot\.gov/files/transborder-raw/\d{4}/[^"]+\.zip)\"""",)


def extract_links(
    pages: DataFrame,
    patterns: tuple[str, ...] = PDF_LINKS,
    prefer: str | None = "railtraffic",
    suffix: str | None = ".pdf",
) -> DataFrame:
    """Distinct links of each page; ``pages`` has (page_id, html).

    Each pattern's first group is a link; links come pattern by pattern, then in
    document order, unescaped and cut at "?".  ``rank`` 0 is the link to follow: the
    first that contains ``prefer``, else the first of all.  Every page is handled
    inside its own row, so nothing is shuffled.
    """
    found = F.concat(*[F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in patterns])
    clean = F.transform(found, lambda x: F.substring_index(unescape(x), "?", 1))
    if suffix:
        clean = F.filter(clean, lambda x: F.lower(x).endswith(suffix))
    links = F.array_distinct(clean)
    if prefer:
        hits = F.filter(links, lambda x: F.contains(F.lower(x), F.lit(prefer)))
        links = F.array_distinct(F.concat(F.slice(hits, 1, 1), links))
    return pages.select("page_id", F.posexplode(links).alias("rank", "url"))
