"""Fixed-width records: byte positions, dropped short lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import PY_WHITESPACE, WAYBILL_WIDTH, waybill_fields
from railyard.functions.stages import evaluate_beside, evaluate_once


_LATIN = "ISO-8859-1"
_HIGH = "".join(chr(b) for b in range(0x80, 0x100))


def _record(line: Column) -> Column:
    """Bytes of a line without trailing CR/LF."""
    raw = line.cast("binary")
    bare = F.encode(F.rtrim(F.decode(raw, _LATIN), F.lit("\r\n")), _LATIN)
    ends = F.substring(raw, -1, 1).isin(F.lit(b"\r"), F.lit(b"\n"))
    return F.when(ends, bare).otherwise(raw)


def slice_fixed_width(
    lines: DataFrame,
    line: str = "line",
    layout: list[tuple[str, int, int, str]] | None = None,
    width: int = WAYBILL_WIDTH,
    keep: list[str] | None = None,
) -> DataFrame:
    """Named, stripped fields of each record; lines shorter than ``width`` are dropped.

    Positions count bytes.  Records of printable ASCII are cut as bytes, without
    walking over characters.  The others are first decoded with one character per
    byte, so positions hold there too, and a byte outside ASCII becomes the
    replacement character.
    """
    layout = layout or waybill_fields()
    kept = keep or []
    # Both stages are evaluated once: filters above read their results, not their code.
    rows = evaluate_once(lines, *kept, _record(F.col(line)).alias("_rec"))
    rows = rows.where(F.octet_length("_rec") >= width)
    odd = F.col("_rec").cast("string").rlike("[^ -~]")
    decoded = F.translate(F.decode("_rec", _LATIN), _HIGH, "\ufffd" * len(_HIGH))
    rows = evaluate_once(rows, *kept, "_rec", odd.alias("_odd"), F.when(odd, decoded).alias("_text"))

    def field(start: int, end: int) -> Column:
        size = end - start
        plain = F.trim(F.substring("_rec", start + 1, size).cast("string"))
        careful = F.btrim(F.substring("_text", start + 1, size), F.lit(PY_WHITESPACE))
        return F.when(F.col("_odd"), careful).otherwise(plain)

    fields = [field(s, e).alias(name) for name, s, e, _ in layout]
    return evaluate_beside(rows, *fields, at_a_time=8).drop("_rec", "_odd", "_text")


def is_short(line: Column, width: int = WAYBILL_WIDTH) -> Column:
    """True for a line with fewer bytes than a record."""
    return F.octet_length(_record(line)) < width


def short_lines(lines: DataFrame, line: str = "line", width: int = WAYBILL_WIDTH) -> DataFrame:
    """(lines, dropped): how many lines there are and how many are too short."""
    too_short = is_short(F.col(line), width)
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(too_short).alias("dropped")
    )


def scan_fixed_width(
    spark: SparkSession,
    path: str,
    layout: list[tuple[str, int, int, str]] | None = None,
    width: int = WAYBILL_WIDTH,
) -> DataFrame:
    """Fields of every record in the text files below ``path`` (splittable scan)."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return slice_fixed_width(lines, "value", layout, width)
