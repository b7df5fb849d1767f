"""Table profiling: column facts, exact quartiles, shape and date bounds."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    StructType,
)

from railyard.session import work_dir


def _missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a float column."""
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def _counted(schema: StructType) -> list[str]:
    """The columns whose distinct values are counted."""
    return [f.name for f in schema.fields if isinstance(f.dataType, (StringType, DateType, DecimalType))]


def _rows(entries: list[Column]) -> Column:
    return F.inline(F.array(*entries))


def profile_columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, non-null count, null percentage and distinct count.

    Distinct values are counted for text, date and decimal columns only.  The exact
    count unpivots those columns to (column, value) and groups by both: copies are
    combined map-side and a column's values spread over all tasks, where several
    ``count(DISTINCT)`` in one aggregate would repeat every whole row per column.
    ``approx`` uses a sketch and needs a single pass.
    """
    counted = _counted(df.schema)
    present = {c: F.count_if(~_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)}
    sketches = [
        F.approx_count_distinct(c).alias(f"d{i}")
        for i, c in enumerate(df.columns)
        if approx and c in counted
    ]
    facts = df.agg(F.count(F.lit(1)).alias("total"), *present.values(), *sketches)

    def entry(i: int, name: str) -> Column:
        nulls = F.col("total") - F.col(f"n{i}")
        share = F.when(F.col("total") > 0, F.bround(nulls / F.col("total") * 100, 1))
        unique = F.col(f"d{i}") if approx and name in counted else F.lit(None)
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(df.schema[name].dataType.simpleString()).alias("dtype"),
            F.col(f"n{i}").alias("non_null"),
            share.alias("null_pct"),
            unique.cast("bigint").alias("unique"),
        )

    profile = facts.select(_rows([entry(i, c) for i, c in enumerate(df.columns)]))
    if approx or not counted:
        return profile
    cells = df.select(
        _rows(
            [
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in counted
            ]
        )
    ).where("value IS NOT NULL")
    distinct = cells.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("_unique"))
    exact = F.when(F.col("column").isin(counted), F.coalesce("_unique", F.lit(0)))
    return profile.join(distinct, "column", "left").select(
        "column", "dtype", "non_null", "null_pct", exact.alias("unique")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of machine numbers; decimals are not summarised."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, DecimalType)
    ]


_QUARTILES = (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
_BINS = 1024

#: Size of the rank sketches, and the rank error that a bracket allows for: more than twice
#: what a sketch of that size makes in 99 of 100 cases.
_SKETCH, _SLACK = 2048, 0.005


def describe_numeric(df: DataFrame, bins: int = _BINS) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, min, quartiles, max.

    Quartiles are exact and interpolate linearly. The input is read twice, whatever its
    distribution. The first pass is one aggregate with the moments and a mergeable rank
    sketch of each column; the sketch brackets each quartile. The second pass counts the
    values below each bracket and keeps those inside, about a hundredth of the rows, grouped
    by value, in a written table. The wanted ranks are found in that table by histograms. A
    bracket that misses its rank, which the counts tell, is replaced by the whole range.
    No value is gathered anywhere; the driver holds a few intervals a column.
    """
    columns = numeric_columns(df)
    if not columns:
        raise ValueError("no numeric column to describe")
    values = {c: _value(df, c) for c in columns}
    wide = df.agg(
        *[
            f(v).alias(f"{name}{i}")
            for i, v in enumerate(values.values())
            for name, f in (
                ("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("lo", F.min), ("hi", F.max),
                ("sketch", lambda v: F.kll_sketch_agg_double(v, F.lit(_SKETCH))),
            )
        ]
    )
    edges = [min(max(p + e, 0.0), 1.0) for _, p in _QUARTILES for e in (-_SLACK, _SLACK)]
    brackets = {
        f"sketch{i}": F.when(
            F.col(f"n{i}") > 0,
            F.kll_sketch_get_quantile_double(f"sketch{i}", F.array(*[F.lit(e) for e in edges])),
        )
        for i in range(len(columns))
    }
    wide = wide.withColumns(brackets).first()
    at = {(c, p): (wide[f"n{i}"] - 1) * p for i, c in enumerate(columns) for _, p in _QUARTILES}
    spans = []
    for i, c in enumerate(columns):
        for j, (_, p) in enumerate(_QUARTILES):
            if wide[f"n{i}"]:
                low, high = wide[f"sketch{i}"][2 * j : 2 * j + 2]
                spans.append((c, low, high, 0, sorted({floor(at[c, p]), ceil(at[c, p])})))
    found: dict[tuple[str, int], float] = {}
    missed = _close_in(df, values, spans, found, bins)
    whole = {c: (wide[f"lo{i}"], wide[f"hi{i}"]) for i, c in enumerate(columns)}
    if missed:
        _close_in(df, values, [(c, *whole[c], 0, ranks) for c, ranks in missed], found, bins)

    def quartile(c: str, p: float) -> float:
        low, high = found[c, floor(at[c, p])], found[c, ceil(at[c, p])]
        return low if low == high else low + (high - low) * (at[c, p] - floor(at[c, p]))

    rows = [
        (
            c, wide[f"n{i}"], wide[f"mean{i}"], wide[f"std{i}"], wide[f"lo{i}"],
            *(quartile(c, p) if wide[f"n{i}"] else None for _, p in _QUARTILES), wide[f"hi{i}"],
        )
        for i, c in enumerate(columns)
    ]
    numbers = ", ".join(f"{c} double" for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, f"`column` string, count bigint, {numbers}")


def _value(df: DataFrame, name: str) -> Column:
    """The column as a double, NaN as null."""
    v = F.col(name).cast("double")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        v = F.when(~F.isnan(name), v)
    return v


# (column, least value, greatest value, rows below, wanted ranks)
_Span = tuple[str, float, float, int, list[int]]


def _held(df: DataFrame, values: dict[str, Column], spans: list[_Span]) -> DataFrame:
    """(span, below, v, n): how many rows lie below each interval, and the values inside.

    A row gives one entry for each column. Its place among the column's intervals is a code
    with a digit for each: 0 below, 1 inside, 2 above. Bounds are looked up in literal arrays,
    which keeps the code of the pass short enough to be compiled.
    """
    of = {c: [i for i, s in enumerate(spans) if s[0] == c] for c in dict.fromkeys(s[0] for s in spans)}
    most = max(len(own) for own in of.values())
    flat = df.select(F.posexplode(F.array(*[values[c] for c in of])).alias("at", "v")).where("v IS NOT NULL")
    nowhere = float("nan")
    code, inside = F.lit(0), F.lit(False)
    for k in range(most):
        low, high = (
            F.get(F.array(*[F.lit(float(spans[own[k]][b]) if k < len(own) else nowhere) for own in of.values()]), F.col("at"))
            for b in (1, 2)
        )
        digit = F.when(F.col("v") < low, 0).when(F.col("v") <= high, 1).otherwise(2)
        code, inside = code + digit * 3**k, inside | (digit == 1)
    places = flat.groupBy("at", code.alias("code"), F.when(inside, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    entries = []
    for a, own in enumerate(of.values()):
        for k, i in enumerate(own):
            digit = F.when(F.col("at") == a, F.floor(F.col("code") / 3**k) % 3)
            entries.append(
                F.struct(
                    F.lit(i).alias("span"),
                    F.coalesce(digit == 0, F.lit(False)).alias("below"),
                    F.when(digit == 1, F.col("v")).alias("v"),
                    F.col("n"),
                )
            )
    return places.select(_rows(entries)).where("below OR v IS NOT NULL")


def _close_in(
    df: DataFrame, values: dict[str, Column], spans: list[_Span], found: dict[tuple[str, int], float], bins: int
) -> list[tuple[str, list[int]]]:
    """Note the values at the wanted ranks; returns the ranks that lie outside their interval.

    One pass over ``df`` writes the values inside the intervals, grouped, and counts those
    below; the rest happens on that table.
    """
    if not spans:
        return []
    spark = df.sparkSession
    stage = work_dir(spark, "brackets")
    _held(df, values, spans).write.parquet(stage)
    cells = spark.read.parquet(stage)
    facts = cells.groupBy("span").agg(
        F.sum(F.when(F.col("below"), F.col("n"))).alias("below"),
        F.sum(F.when(~F.col("below"), F.col("n"))).alias("n"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )
    inside = {r["span"]: r for r in facts.collect()}
    cells = cells.where("NOT below")
    missed, open_ = [], {}
    for i, (c, _, _, _, ranks) in enumerate(spans):
        part = inside.get(i)
        base = (part and part["below"]) or 0
        covered = [r for r in ranks if part and base <= r < base + (part["n"] or 0)]
        if covered:
            open_[i] = (c, part["low"], part["high"], base, covered)
        if len(covered) < len(ranks):
            missed.append((c, [r for r in ranks if r not in covered]))
    rounds = list(open_.items())
    while rounds := _settle(rounds, found):
        rounds = _narrow(cells, rounds, bins)
    return missed


def _settle(spans: list[tuple[int, _Span]], found: dict[tuple[str, int], float]) -> list[tuple[int, _Span]]:
    """Note the ranks of intervals that hold one value; the others stay open."""
    for _, (column, low, high, _, ranks) in spans:
        if low == high:
            found.update(dict.fromkeys([(column, r) for r in ranks], low))
    return [s for s in spans if s[1][1] != s[1][2]]


def _bin(v: Column, low: float, high: float, bins: int) -> Column:
    """The bin of a value; infinite ones have the outer bins to themselves."""
    a, z = max(low, -_LARGEST) / 2, min(high, _LARGEST) / 2
    inner = F.floor((v / 2 - a) / (z - a) * (bins - 3)) + 1 if z > a else F.lit(1)
    inside = F.least(F.greatest(inner, F.lit(1)), F.lit(bins - 2))
    return F.when(v == float("-inf"), 0).when(v == float("inf"), bins - 1).otherwise(inside).cast("int")


_LARGEST = 1.7976931348623157e308


def _narrow(cells: DataFrame, spans: list[tuple[int, _Span]], bins: int) -> list[tuple[int, _Span]]:
    """One histogram round over all open intervals of the grouped values (span, v, n)."""
    entries = []
    for i, (of, (_, low, high, _, _)) in enumerate(spans):
        held = (F.col("span") == of) & F.col("v").between(low, high)
        entries.append(
            F.struct(F.lit(i).alias("at"), F.when(held, F.col("v")).alias("v"), F.col("n"), _bin(F.col("v"), low, high, bins).alias("bin"))
        )
    table = cells.select(_rows(entries)).where("v IS NOT NULL").groupBy("at", "bin").agg(
        F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    upto = F.sum("n").over(W.partitionBy("at").orderBy("bin"))
    table = table.withColumn("before", upto - F.col("n"))
    inner = F.lit(False)
    for i, (_, (_, _, _, base, ranks)) in enumerate(spans):
        for r in ranks:
            held = (F.col("before") <= r - base) & (F.lit(r - base) < F.col("before") + F.col("n"))
            inner = inner | ((F.col("at") == i) & held)
    out = []
    for r in table.where(inner).collect():
        of, (column, _, _, base, ranks) = spans[r["at"]]
        low = base + r["before"]
        out.append((of, (column, r["low"], r["high"], low, [k for k in ranks if low <= k < low + r["n"]])))
    return out


def table_shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def date_bounds(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """(min_date, max_date)."""
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


#: Size of the distinct sketches: their error is about 0.8 %, and few values are exact.
_DISTINCT = 14


def partition_facts(df: DataFrame, partition: Column) -> DataFrame:
    """(partition, column, dtype, rows, non_null, sketch) of each partition and column.

    One aggregate; a sketch of distinct values has the same size however many there are.
    """
    counted = _counted(df.schema)
    facts = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        missing = _missing(df, f.name)
        facts.append(F.count_if(~missing).alias(f"_n{i}"))
        if f.name in counted:
            facts.append(F.hll_sketch_agg(F.when(~missing, F.col(f.name).cast("string")), _DISTINCT).alias(f"_s{i}"))
    wide = df.withColumn("_partition", partition).groupBy("_partition").agg(*facts)
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("_rows").alias("rows"),
            F.col(f"_n{i}").alias("non_null"),
            (F.col(f"_s{i}") if f.name in counted else F.lit(None).cast("binary")).alias("sketch"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return wide.select(F.col("_partition").alias("partition"), _rows(entries))


def united_profile(facts: DataFrame) -> DataFrame:
    """The profile of all partitions in ``facts``, as ``profile_columns`` with ``approx``."""
    total = facts.groupBy("column", "dtype").agg(
        F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"), F.hll_union_agg("sketch").alias("sketch"),
        F.count("sketch").alias("sketches"),
    )
    share = F.when(F.col("rows") > 0, F.bround((F.col("rows") - F.col("non_null")) / F.col("rows") * 100, 1))
    unique = F.when(F.col("sketches") > 0, F.hll_sketch_estimate("sketch"))
    return total.select("column", "dtype", "non_null", share.alias("null_pct"), unique.cast("bigint").alias("unique"))
