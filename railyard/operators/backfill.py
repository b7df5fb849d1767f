"""Backfill selection: what to load, from which release or member, and recovery.

Months are compared as one number, ``year * 12 + month``.  The as-of join never pairs
requests with releases: both sides are first reduced to distinct months, so the only
ordered step runs over a group no longer than the calendar, and requests come back
by an equality join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.constants import CUMULATIVE_MEMBER, LEGACY_MEMBER, MONTHLY_MEMBER
from railyard.functions import release_month, strip
from railyard.functions.stages import evaluate_beside
from railyard.sources.archives import classify_view


def _month_number(year: Column | str, month: Column | str) -> Column:
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return (y * 12 + m).cast("bigint")


def expand_targets(tokens: DataFrame, column: str = "token") -> DataFrame:
    """Distinct (year, month) named by tokens "2007", "2009-2011" or "2017-05".

    The second part of a token is a year when it is above 12, else a month.
    """
    parts = F.split(F.col(column), "-")
    first = F.get(parts, F.lit(0)).cast("int")
    second = F.get(parts, F.lit(1)).cast("int")
    last_year = F.when(second > 12, second).otherwise(first)
    years = F.when(last_year >= first, F.sequence(first, last_year))
    one_month = second.isNotNull() & (second <= 12)
    months = F.when(one_month, F.array(second)).otherwise(F.sequence(F.lit(1), F.lit(12)))
    return (
        tokens.select(F.explode(years).alias("year"), months.alias("months"))
        .select("year", F.explode("months").alias("month"))
        .distinct()
    )


def parse_targets(spark: SparkSession, tokens: list[str]) -> DataFrame:
    """(year, month) rows of command tokens; no token means no row, i.e. everything."""
    return expand_targets(spark.createDataFrame([(t,) for t in tokens], "token string"))


def select_targets(releases: DataFrame, targets: DataFrame | None) -> DataFrame:
    """Releases of the targeted months; without targets all of them."""
    if targets is None:
        return releases
    return releases.join(targets.select("year", "month"), ["year", "month"], "left_semi")


def missing_partitions(
    wanted: DataFrame, stored: DataFrame, keys: list[str] | None = None, force: bool = False
) -> DataFrame:
    """Requested partitions that are not stored yet; ``force`` asks for all again."""
    keys = keys or ["year", "month"]
    if force:
        return wanted
    return wanted.join(stored.select(*keys).distinct(), keys, "left_anti")


def except_months(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct requested months minus the stored ones."""
    return wanted.select("year", "month").subtract(stored.select("year", "month"))


def parse_releases(links: DataFrame, url: str = "url") -> DataFrame:
    """(year, month, url) of archive links; links without a month name are left out."""
    year, month = release_month(F.col(url))
    out = links.select(year.alias("year"), month.alias("month"), F.col(url).alias("url"))
    return out.where("year IS NOT NULL")


def order_releases(releases: DataFrame) -> DataFrame:
    """Distinct releases, newest first."""
    return releases.distinct().orderBy(F.desc("year"), F.desc("month"), F.desc("url"))


def asof_release(
    requests: DataFrame,
    releases: DataFrame,
    max_years: int | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Adds (release_year, release_month, url): the newest release not after the request.

    ``requests`` has (year, month) plus any other columns, a null month asking for the
    newest release of all; ``releases`` has (year, month, url).  Nothing newer than the
    request is ever chosen.  ``max_years`` limits the look-back, counting the request's
    own year.  ``by`` names columns that must be equal on both sides.
    """
    keys = by or []
    best = releases.groupBy(*keys, "year", "month").agg(F.max("url").alias("url"))
    best = best.select(
        *keys,
        _month_number("year", "month").alias("_ym"),
        F.struct(
            F.col("year").alias("y"), F.col("month").alias("m"), F.col("url").alias("u")
        ).alias("_rel"),
    )
    newest = F.lit(9999 * 12 + 12).cast("bigint")
    asked = requests.withColumn("_ym", F.coalesce(_month_number("year", "month"), newest))
    points = asked.select(*keys, "_ym").distinct().withColumn("_rel", F.lit(None))
    line = best.unionByName(points)
    upto = W.partitionBy(*keys).orderBy("_ym").rangeBetween(W.unboundedPreceding, W.currentRow)
    release_ym = F.when(F.col("_rel").isNotNull(), F.col("_ym"))
    known = (
        line.withColumn("_found", F.max_by("_rel", release_ym).over(upto))
        .groupBy(*keys, "_ym")
        .agg(F.first("_found").alias("_found"))
    )
    out = asked.join(known, [*keys, "_ym"], "left")
    found = F.col("_found")
    if max_years is not None:
        recent = F.col("year").isNull() | (found["y"] > F.col("year") - max_years)
        found = F.when(recent, found)
    return out.select(
        *requests.columns,
        found["y"].alias("release_year"),
        found["m"].alias("release_month"),
        found["u"].alias("url"),
    )


def register_members(members: DataFrame) -> DataFrame:
    """Adds (kind, year, month, view) to the members that hold border-trade data.

    ``kind`` is "monthly" or "ytd" (cumulative); other members are left out.  Two
    digits of year mean 20yy.  Members under the legacy name are told apart by their
    header, because the number in the name does not match the view.
    """
    base = F.element_at(F.split("member", "/"), -1)

    def named(pattern: str, kind: str, view: Column, mm: int, yy: int) -> Column:
        return F.when(
            base.rlike(pattern),
            F.struct(
                F.lit(kind).alias("kind"),
                (2000 + F.regexp_extract(base, pattern, yy).cast("int")).alias("year"),
                F.regexp_extract(base, pattern, mm).cast("int").alias("month"),
                view.alias("view"),
            ),
        )

    monthly_view = F.concat(F.lit("dot"), F.regexp_extract(base, MONTHLY_MEMBER, 1))
    ytd_view = F.concat(F.lit("dot"), F.regexp_extract(base, CUMULATIVE_MEMBER, 1))
    if "header" in members.columns:
        legacy_view = F.when(
            F.col("header").isNotNull(), classify_view(F.col("header").cast("string"))
        )
    else:
        legacy_view = F.lit(None).cast("string")
    found = F.coalesce(
        named(MONTHLY_MEMBER, "monthly", monthly_view, 2, 3),
        named(CUMULATIVE_MEMBER, "ytd", ytd_view, 2, 3),
        named(LEGACY_MEMBER, "monthly", legacy_view, 1, 2),
    )
    kept = [c for c in members.columns if c not in ("kind", "year", "month", "view")]
    # One stage: pasted into the filter and into each field, the patterns would run five times.
    tagged = evaluate_beside(members.select(*kept), found.alias("_f"))
    return tagged.where("_f.view IS NOT NULL").select(*kept, "_f.*")


def prefer_outer_members(registered: DataFrame) -> DataFrame:
    """Inner archives count only where the outer one exposes no monthly member.

    The rule is decided by one small aggregate per archive and joined back, so an
    archive with a huge member list is not gathered in one task.
    """
    exposed = F.max(F.when(F.col("kind") == "monthly", ~F.col("inner")).otherwise(F.lit(False)))
    flags = registered.groupBy("archive").agg(exposed.alias("_exposed"))
    kept = registered.join(flags, "archive").where(~F.col("inner") | ~F.col("_exposed"))
    return kept.drop("_exposed")


def pick_member(registered: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The one member to read per (kind, year, month, view).

    Of several monthly copies the shortest path wins, then the first by name (or by
    archive order when known); of several cumulative ones the last in archive order.
    """
    keys = [*(by or []), "kind", "year", "month", "view"]
    order = F.col("member_no") if "member_no" in registered.columns else F.col("member")
    shortest = F.min_by(F.struct("*"), F.struct(F.length("member"), order, F.col("member")))
    last = F.max_by(F.struct("*"), F.struct(order, F.col("member")))
    best = registered.groupBy(*keys).agg(shortest.alias("_short"), last.alias("_last"))
    chosen = F.when(F.col("kind") == "monthly", F.col("_short")).otherwise(F.col("_last"))
    return best.select(chosen.alias("_m")).select("_m.*")


def find_recovery(
    gaps: DataFrame, ytd_members: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """Adds (ytd_month, ytd_member) to each gap: the earliest later cumulative view.

    ``gaps`` and ``ytd_members`` have (year, month, view) and the ``by`` columns, such
    as the archive; a year has twelve months, so a gap meets at most eleven candidates.
    """
    keys = [*(by or []), "year", "view"]
    later = ytd_members.groupBy(*keys, F.col("month").alias("ytd_month")).agg(
        F.max("member").alias("ytd_member")
    )
    pairs = gaps.join(later, keys).where(F.col("ytd_month") > F.col("month"))
    best = pairs.groupBy(*keys, "month").agg(
        F.min_by("ytd_member", "ytd_month").alias("ytd_member"),
        F.min("ytd_month").alias("ytd_month"),
    )
    return gaps.join(best, [*keys, "month"], "left")


def recover_from_ytd(
    gaps: DataFrame, ytd_members: DataFrame, ytd_rows: DataFrame, by: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, unrecovered): unreadable months rebuilt from later cumulative views.

    ``ytd_rows`` has the raw columns plus ``member`` and the ``by`` columns.  Of the
    chosen member only the rows of the gap's own YEAR and two-digit MONTH are taken.  A
    month without a later view is reported, never guessed.
    """
    keys = by or []
    plan = find_recovery(gaps, ytd_members, by)
    usable = plan.where(F.col("ytd_member").isNotNull()).select(
        *keys,
        F.col("ytd_member").alias("member"),
        F.col("year").cast("string").alias("_year"),
        F.lpad(F.col("month").cast("string"), 2, "0").alias("_month"),
    )
    on = (strip(ytd_rows["YEAR"]) == usable["_year"]) & (
        strip(ytd_rows["MONTH"]) == usable["_month"]
    )
    for key in [*keys, "member"]:
        on = on & (ytd_rows[key] == usable[key])
    rows = ytd_rows.join(usable, on, "left_semi")
    unrecovered = plan.where(F.col("ytd_member").isNull()).select(*keys, "year", "month", "view")
    return rows, unrecovered
