"""Zip archives of any size: member listings and member lines.

Inflating is the one step Spark has no operator for.  A listing reads the directory at an
archive's end and gives one row for each member, with its place in the file; DataFrame
operators (:mod:`railyard.operators.backfill`) decide which members are worth reading; then
members, not archives, are dealt to tasks, and each task reads the byte ranges of its own.
No archive's content is ever a value in a row.
"""

from __future__ import annotations

import bz2
import codecs
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import groupby
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions import strip
from railyard.session import work_dir
from railyard.sources.ranged import Opener, list_files, open_file

_LISTING = (
    "archive string, member string, member_no int, inner boolean, header binary, error string,"
    " within string, name string, spot bigint, packed bigint, method int, crc bigint, locked boolean"
)
_LINES = "archive string, member string, line_no bigint, line binary, encoding string, error string"
_SCHEMA = pa.schema(
    [("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.binary()),
     ("encoding", pa.string()), ("error", pa.string())]
)
_BATCH_LINES = 20_000
_CHUNK = 1 << 20

#: Packed bytes of the members that one task reads, unless a single one has more.
TASK_BYTES = 64 << 20

#: What a damaged archive or member raises; a store that fails raises OSError and is no news
#: about the data, so the task fails and is tried again.
_DAMAGE = (zipfile.BadZipFile, zlib.error, NotImplementedError, EOFError, ValueError, struct.error, RuntimeError)


def find_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, length) of every zip below ``path``; nothing is read yet."""
    return list_files(spark, path, "*.[zZ][iI][pP]").withColumnRenamed("path", "archive")


def list_members(
    archives: DataFrame, header_suffix: str | None = ".csv", inner: bool = True, opener: Opener = open_file
) -> DataFrame:
    """Every member of each archive (column ``archive``: its path), also of archives inside.

    ``member_no`` is the order inside the archive; ``header`` is the first line of
    members ending in ``header_suffix`` (None: no member's).  An archive that cannot be opened gives one
    row with an ``error``.  Members of an inner archive are named ``inner.zip!/member``.
    The other columns say where a member lies; ``scan_chosen_members`` reads by them.  Only
    directories and first lines are read, and with ``inner`` the archives inside.
    """
    names = _names(_LISTING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                for part in _portions(_listing_rows(archive, header_suffix, inner, opener), 10_000):
                    columns = list(zip(*part, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, _LISTING_TYPES, strict=True)], names
                    )

    return archives.select("archive").mapInArrow(run, _LISTING)


def scan_archive_members(
    archives: DataFrame, suffixes: Iterable[str], require_data: bool = False, opener: Opener = open_file
) -> DataFrame:
    """Lines of all members with one of the ``suffixes``; inner archives are not opened.

    An unreadable archive or member gives one row with an ``error`` and no line; a
    member is either complete or an error, never cut short.  ``require_data`` makes an
    archive without such a member an error.  ``encoding`` is UTF-8 when the whole
    member is valid UTF-8 (a byte-order mark is removed), else ISO-8859-1.
    """
    spark = archives.sparkSession
    ends = tuple(s.lower() for s in suffixes)
    path = work_dir(spark, "members")
    list_members(archives, None, False, opener).write.parquet(path)
    listing = spark.read.parquet(path)
    has_end = F.lit(False)
    for end in ends:
        has_end = has_end | F.lower("member").endswith(end)
    data = F.col("member").isNotNull() & has_end & F.col("error").isNull()
    lines = scan_chosen_members(listing.where(data), opener)
    lost = listing.where(F.col("member").isNull())
    errors = lost.select("archive", "member", "error")
    if require_data:
        none = f"no data member ({'/'.join(ends)})"
        found = listing.groupBy("archive").agg(
            F.max(F.coalesce(data, F.lit(False))).alias("found"), F.max(F.col("member").isNull()).alias("lost")
        )
        empty = archives.select("archive").join(found.where("found OR lost"), "archive", "left_anti")
        errors = errors.unionByName(
            empty.select("archive", F.lit(None).cast("string").alias("member"), F.lit(none).alias("error"))
        )
    nothing = {"line_no": "bigint", "line": "binary", "encoding": "string"}
    errors = errors.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    # A member's lines leave one task; what follows is spread over the cluster.
    return lines.unionByName(errors).hint("rebalance")


def scan_chosen_members(chosen: DataFrame, opener: Opener = open_file) -> DataFrame:
    """Lines of the members in ``chosen``, rows of a listing.

    Members are dealt to as many tasks as their bytes ask for, whichever archive they lie
    in; those of one compressed inner archive stay together and are read in one go.
    """
    names = _names(_LISTING)[6:]
    spark = chosen.sparkSession
    path = work_dir(spark, "chosen")
    chosen.select("archive", "member", "error", *names).write.parquet(path)
    places = spark.read.parquet(path)
    size, units = places.agg(F.sum("packed"), F.count_distinct("archive", F.coalesce("within", "member"))).first()
    tasks = max(1, min(units, max(-(-(size or 0) // TASK_BYTES), spark.sparkContext.defaultParallelism)))
    unit = F.xxhash64("archive", F.coalesce("within", "member"))
    dealt = places.repartition(tasks, unit).sortWithinPartitions("archive", "within", "spot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for (archive, within), members in groupby(rows, lambda r: (r["archive"], r["within"])):
            yield from _in_batches(_unit_lines(archive, within, members, opener))

    return dealt.mapInArrow(run, _LINES)


def classify_view(header: Column) -> Column:
    """View of a border-trade CSV from its header, for members whose names lie."""
    columns = F.transform(F.split(header, ","), lambda x: F.upper(strip(x)))
    return (
        F.when(
            F.array_contains(columns, "COMMODITY2") & F.array_contains(columns, "USASTATE"),
            F.lit("dot2"),
        )
        .when(F.array_contains(columns, "COMMODITY2"), F.lit("dot3"))
        .otherwise(F.lit("dot1"))
    )


def filter_members(members: DataFrame) -> DataFrame:
    """CSV members that are real monthly data: no resource forks, no cumulative views."""
    name = F.col("member")
    junk = name.startswith("__MACOSX/") | F.contains(name, F.lit("/._")) | name.startswith("._")
    cumulative = F.contains(F.lower(name), F.lit("_ytd_"))
    return members.where(F.lower(name).endswith(".csv") & ~junk & ~cumulative)


_LISTING_TYPES = [
    {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "bigint": pa.int64()}[
        part.split()[1]
    ]
    for part in _LISTING.split(",")
]


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def _portions(rows: Iterable, size: int) -> Iterator[list]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def _listing_rows(archive: str, header_suffix: str | None, inner: bool, opener: Opener) -> Iterator[tuple]:
    number = 0

    def rows(file: BinaryIO, zf: zipfile.ZipFile, prefix: str, within: str | None) -> Iterator[tuple]:
        nonlocal number
        for info in zf.infolist():
            if info.is_dir():
                continue
            name = info.filename
            place = (within, name, info.header_offset, info.compress_size, info.compress_type, info.CRC, bool(info.flag_bits & 1))
            header, error = None, None
            if header_suffix is not None and name.lower().endswith(header_suffix):
                try:
                    header = _first_line(file, archive, place)
                except _DAMAGE as exc:
                    error = f"member unreadable: {exc}"
            yield (archive, prefix + name, number, bool(prefix), header, error, *place)
            number += 1

    nowhere = (None,) * 7
    with opener(archive) as file:
        try:
            outer = zipfile.ZipFile(file)
        except _DAMAGE as exc:
            yield (archive, None, number, False, None, f"archive unreadable: {exc}", *nowhere)
            return
        with outer:
            yield from rows(file, outer, "", None)
            for info in outer.infolist():
                if not inner or not info.filename.lower().endswith(".zip") or info.is_dir():
                    continue
                try:
                    with outer.open(info) as inside, zipfile.ZipFile(inside) as nested:
                        yield from rows(inside, nested, info.filename + "!/", info.filename)
                except _DAMAGE as exc:
                    yield (archive, info.filename, number, True, None, f"inner zip unreadable: {exc}", *nowhere)
                    number += 1


def _inflated(file: BinaryIO, place: tuple) -> Iterator[bytes]:
    """The bytes of the member at a place, chunk by chunk; damage raises at the latest at the end."""
    _, name, spot, packed, method, crc, locked = place
    if locked:
        raise RuntimeError(f"{name} is encrypted")
    file.seek(spot)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("Bad magic number for file header")
    file.seek(spot + 30 + sum(struct.unpack("<HH", head[26:30])))
    if method == zipfile.ZIP_STORED:
        unpack = None
    elif method == zipfile.ZIP_DEFLATED:
        unpack = zlib.decompressobj(-15)
    elif method == zipfile.ZIP_BZIP2:
        unpack = bz2.BZ2Decompressor()
    else:
        raise NotImplementedError(f"compression method {method}")
    seen, left = 0, packed
    while left:
        raw = file.read(min(left, _CHUNK))
        if not raw:
            raise EOFError("the archive ends within the member")
        left -= len(raw)
        for chunk in _unpacked(unpack, raw):
            seen = zlib.crc32(chunk, seen)
            if chunk:
                yield chunk
    rest = unpack.flush() if method == zipfile.ZIP_DEFLATED else b""
    if zlib.crc32(rest, seen) != crc:
        raise zipfile.BadZipFile(f"Bad CRC-32 for file {name!r}")
    if rest:
        yield rest


def _unpacked(unpack, raw: bytes) -> Iterator[bytes]:
    """What packed bytes inflate to, no more than a chunk at a time however dense they are."""
    if unpack is None:
        yield raw
    elif isinstance(unpack, bz2.BZ2Decompressor):
        yield unpack.decompress(raw, _CHUNK)
        while not (unpack.needs_input or unpack.eof):
            yield unpack.decompress(b"", _CHUNK)
    else:
        while raw:
            yield unpack.decompress(raw, _CHUNK)
            raw = unpack.unconsumed_tail


def _first_line(file: BinaryIO, archive: str, place: tuple) -> bytes:
    line = b""
    for chunk in _inflated(file, place):
        head, end, _ = chunk.partition(b"\n")
        line += head
        if end:
            break
    return line.rstrip(b"\r\n").removeprefix(codecs.BOM_UTF8)


@contextmanager
def _unit(archive: str, within: str | None, opener: Opener) -> Iterator[BinaryIO]:
    """An archive's file, or the stream of an archive inside it."""
    with opener(archive) as file:
        if within is None:
            yield file
        else:
            with zipfile.ZipFile(file) as outer, outer.open(within) as inside:
                yield inside


def _unit_lines(archive: str, within: str | None, members: Iterator[dict], opener: Opener) -> Iterator[tuple]:
    """(member, first line's number, lines, encoding, error) of the members of one unit.

    Two passes, both in the order of the file: the first checks that a member inflates to its
    end and finds its encoding, the second gives its lines. A stream inside an archive is
    rewound once for all members, a plain file for each.
    """
    names = _names(_LISTING)[6:]
    plain = within is None
    for group in ([m] for m in members) if plain else (list(members),):
        try:
            with _unit(archive, within, opener) as file:
                good = []
                for m in group:
                    place = tuple(m[n] for n in names)
                    try:
                        good.append((m["member"], place, _encoding(file, place)))
                    except _DAMAGE as exc:
                        yield (archive, m["member"], 0, None, None, f"member unreadable: {exc}")
                for member, place, encoding in good:
                    number = 0
                    for lines in _lines(_inflated(file, place), member.lower().endswith(".csv")):
                        yield (archive, member, number, lines, encoding, None)
                        number += len(lines)
        except _DAMAGE as exc:
            for m in group:
                yield (archive, m["member"], 0, None, None, f"archive unreadable: {exc}")


def _lines(chunks: Iterator[bytes], csv: bool) -> Iterator[list[bytes]]:
    """The lines of a member, some at a time; a quoted CSV field may hold line breaks."""
    rest, pending, inside, begun = b"", [], False, False

    def done(line: bytes) -> bytes:
        return line.rstrip(b"\r\n")

    for chunk in chunks:
        if not begun:
            # The mark has three bytes; a chunk may be shorter.
            chunk = rest + chunk
            rest = b""
            if len(chunk) < 3:
                rest = chunk
                continue
            chunk, begun = chunk.removeprefix(codecs.BOM_UTF8), True
        *whole, rest = (rest + chunk).split(b"\n")
        if not whole:
            continue
        if not csv or (not inside and not any(b'"' in x for x in whole)):
            yield [done(x) for x in whole]
            continue
        out = []
        for line in whole:
            pending.append(line + b"\n")
            inside = _ends_quoted(pending[-1], inside)
            if not inside:
                out.append(done(b"".join(pending)))
                pending = []
        if out:
            yield out
    last = b"".join(pending) + rest
    if last and (begun or last != codecs.BOM_UTF8):
        yield [done(last)]


def _ends_quoted(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line.

    A quote opens a field only as its first byte; inside, two quotes are one of the text.
    """
    at, size = 0, len(line)
    if not inside and b'"' not in line:
        return False
    while at < size:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            inside, at = False, at + 1
        elif line[at : at + 1] == b'"' and (at == 0 or line[at - 1 : at] == b","):
            inside, at = True, at + 1
        else:
            at = line.find(b",", at) + 1
            if not at:
                return False
    return inside


def _encoding(file: BinaryIO, place: tuple) -> str:
    decoder = codecs.getincrementaldecoder("utf-8")()
    valid = True
    for chunk in _inflated(file, place):
        if valid:
            try:
                decoder.decode(chunk)
            except UnicodeDecodeError:
                valid = False
    if valid:
        try:
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            valid = False
    return "UTF-8" if valid else "ISO-8859-1"


def _in_batches(portions: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    for archive, member, first, lines, encoding, error in portions:
        for at in range(0, len(lines), _BATCH_LINES) if lines is not None else (None,):
            part = [None] if at is None else lines[at : at + _BATCH_LINES]
            numbers = [None] if at is None else range(first + at, first + at + len(part))
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([archive] * n, pa.string()),
                    pa.array([member] * n, pa.string()),
                    pa.array(numbers, pa.int64()),
                    pa.array(part, pa.binary()),
                    pa.array([encoding] * n, pa.string()),
                    pa.array([error] * n, pa.string()),
                ],
                schema=_SCHEMA,
            )
