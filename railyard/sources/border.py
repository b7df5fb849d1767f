"""Border-trade CSV in its three column layouts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import BORDER_COLUMNS, BORDER_VIEWS
from railyard.functions import raw_json, view_tag
from railyard.functions.stages import evaluate_beside, evaluate_once
from railyard.sources.archives import filter_members
from railyard.sources.ranged import Opener, list_files, open_file

_BOM = "\ufeff"


def scan_transborder_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all monthly dot1/dot2/dot3 CSV files below ``path``, tagged with their view.

    Columns are found by the names in each file's own header.  Cumulative files
    (``_ytd_``) and resource forks are left out: their rows stand in monthly files.
    """
    return scan_view(spark, path, "dot1", "[dD][oO][tT][123]_*.csv")


def scan_view(
    spark: SparkSession, path: str, view: str, pattern: str, opener: Opener = open_file
) -> DataFrame:
    """Rows of the CSV files found by file name pattern, each bound by its own header.

    The tag is the file's own when its name starts with a view, else ``view``.

    A header is a first line with a field named TRDTYPE; a file without one has no rows.
    Files are grouped by the header that the registry has for them, and each layout is one
    CSV scan with its own schema: bodies are read once, and no row meets a header by a join.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    # One row for each file, as many as the scans below list.
    for row in header_registry(spark, path, pattern, opener).collect():
        names = tuple(row["names"])
        if "TRDTYPE" in names:
            layouts.setdefault(names, []).append(row["path"])
    scans = [_scan_layout(spark, names, files, view) for names, files in sorted(layouts.items())]
    if not scans:
        empty = ", ".join(f"{c} string" for c in [*BORDER_COLUMNS, "source_file", "raw_record"])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, scans)


def header_registry(
    spark: SparkSession, path: str, pattern: str = "*.csv", opener: Opener = open_file
) -> DataFrame:
    """(path, names) of each monthly CSV file; only first lines are read, in tasks."""
    files = filter_members(list_files(spark, path, pattern).withColumn("member", F.col("path")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [_first_line(opener, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(heads, pa.string())], ["path", "head"])

    spread = files.select("path").repartition(spark.sparkContext.defaultParallelism, "path")
    heads = spread.mapInArrow(run, "path string, head string")
    return heads.select("path", _names(F.col("head")).alias("names"))


def _first_line(opener: Opener, path: str) -> str:
    line = b""
    with opener(path) as file:
        while chunk := file.read(1 << 14):
            head, end, _ = chunk.partition(b"\n")
            line += head
            if end:
                break
    line = line.rstrip(b"\r")
    try:
        return line.decode("utf-8")
    except UnicodeDecodeError:
        return line.decode("latin-1")


def _scan_layout(spark: SparkSession, names: tuple[str, ...], files: list[str], view: str) -> DataFrame:
    """The rows of files that share a header; of equal names the first column counts."""
    cells = [f"c{i}" for i in range(len(names))]
    # A path given to a reader is a pattern, so a file's own special characters are escaped.
    plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in sorted(files)]
    rows = spark.read.schema(", ".join(f"{c} string" for c in cells)).csv(plain)
    tag = F.lower(view_tag(F.element_at(F.split("_metadata.file_path", "/"), -1)))
    tag = F.when(tag.isin(list(BORDER_VIEWS)), tag).otherwise(F.lit(view))
    first = F.regexp_replace(F.trim(f"c{names.index('TRDTYPE')}"), f"^{_BOM}", "")
    body = rows.where(F.coalesce(first != "TRDTYPE", F.lit(True)))
    picked = [
        (_blank(F.col(f"c{names.index(c)}")) if c in names else F.lit(None).cast("string")).alias(c)
        for c in BORDER_COLUMNS
    ]
    found = body.select(*picked, tag.alias("source_file"))
    return found.withColumn("raw_record", raw_json(*BORDER_COLUMNS))


def _names(header: Column) -> Column:
    """The column names in a header line."""
    bare = F.regexp_replace(header, f"^{_BOM}", "")
    return F.transform(F.split(bare, ","), lambda x: F.trim(F.trim(x), F.lit('"')))


def _pick(at: int) -> Column:
    """The value of a border column; null where the header lacks its name."""
    spot = F.get("spots", F.lit(at))
    return F.when(spot > 0, _blank(F.get("values", spot - 1))).alias(BORDER_COLUMNS[at])


def parse_csv_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Border-trade rows from member lines, each bound to its own member's header.

    ``lines`` has (archive, member, line_no, line, encoding), ``headers`` has
    (archive, member, header, view).  Columns are found by name, whatever their order and
    number; the widest header is counted first.  The result keeps ``archive`` and ``member``.
    """
    names = _names(_decoded(F.col("header"), F.lit("UTF-8")))
    known = evaluate_once(headers, "archive", "member", "view", names.alias("names"))
    width = known.agg(F.max(F.size("names")).alias("n")).first()["n"] or 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    # Names are looked up once for each member, not for each line.
    spots = [F.array_position("names", F.lit(c)).cast("int") for c in BORDER_COLUMNS]
    known = evaluate_once(known, "archive", "member", "view", F.array(*spots).alias("spots"))
    text = _decoded(F.col("line"), F.col("encoding"))
    fields = F.from_csv(text, F.lit(schema)).alias("f")
    body = lines.where("line_no > 0 AND line IS NOT NULL AND octet_length(line) > 0")
    kept = ["archive", "member", "spots", "view"]
    # A line is parsed in a stage of its own: pasted into what reads its fields, filters and
    # the record among them, the parse would run for each field again.
    parsed = evaluate_once(body.join(known, ["archive", "member"]), *kept, fields)
    values = evaluate_once(parsed, *kept, F.array(*[f"f.c{i}" for i in range(width)]).alias("values"))
    picked = evaluate_beside(values, *[_pick(i) for i in range(len(BORDER_COLUMNS))])
    rows = picked.select("archive", "member", *BORDER_COLUMNS, F.col("view").alias("source_file"))
    return rows.withColumn("raw_record", raw_json(*BORDER_COLUMNS))


def _blank(c: Column) -> Column:
    """An empty field of a present column is text, not a missing value."""
    return F.coalesce(c, F.lit(""))


def _decoded(raw: Column, encoding: Column) -> Column:
    latin = F.decode(raw, "ISO-8859-1")
    utf8 = F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(latin)
    return F.when(encoding == "ISO-8859-1", latin).otherwise(utf8)
