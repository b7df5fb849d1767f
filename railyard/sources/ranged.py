"""Reading parts of files inside tasks: Spark's readers have no operator for a byte range."""

from __future__ import annotations

from collections.abc import Callable
from typing import BinaryIO
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

Opener = Callable[[str], BinaryIO]


def open_file(path: str) -> BinaryIO:
    """A seekable file on whatever store its scheme names; only the parts asked for are read.

    Local paths, ``s3``, ``gs``, ``abfs`` and ``hdfs`` are known. For another store pass a
    function like this one as ``opener``.
    """
    if path.startswith("/") or path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    uri = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    store, inner = fs.FileSystem.from_uri(quote(uri, safe=":/@+,=;$&'()*!~"))
    return store.open_input_file(inner)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of every file below ``path`` whose name matches; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )
