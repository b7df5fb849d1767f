"""Scans of landed API payloads: flat JSON pages, series documents, rates, RSS."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from railyard.functions import truthy
from railyard.sources.ranged import Opener, list_files, open_file

_ITEMS = "array<struct<title:string,link:string>>"


def scan_json_feed(
    spark: SparkSession, path: str, columns: list[str], multiline: bool = True, opener: Opener = open_file
) -> DataFrame:
    """All pages of a feed of flat JSON objects, every value as text.

    A page is one file holding an array (``multiline``) or one object per line.
    ``raw_record`` is the whole object as it stands in the page, fields that ``columns``
    does not name included.  A page of any size is read piece by piece and never is a value
    itself; one that ends within a value is an error.
    """
    if multiline:
        objects = _page_objects(spark, path, opener)
    else:
        lines = spark.read.option("recursiveFileLookup", "true").text(path).where(F.trim("value") != "")
        objects = lines.select(F.col("value").alias("raw_record"))
    schema = StructType([StructField(c, StringType()) for c in columns])
    return objects.withColumn("f", F.from_json("raw_record", schema)).select("f.*", "raw_record")


def _page_objects(spark: SparkSession, path: str, opener: Opener) -> DataFrame:
    """(raw_record) of every object of all pages below ``path``; pages are dealt to tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0).to_pylist():
                held, size = [], 0
                with opener(page) as file:
                    for text in json_objects(iter(lambda: file.read(_PIECE), b""), page):
                        held.append(text)
                        size += len(text)
                        if size >= _PIECE:
                            yield _text_batch(held)
                            held, size = [], 0
                if held:
                    yield _text_batch(held)

    pages = list_files(spark, path).select("path")
    spread = pages.repartition(spark.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(run, "raw_record string")


_PIECE = 1 << 20

#: A string, closed or not, or a bracket: all that decides where an object ends.
_TOKEN = re.compile(rb'"(?:[^"\\]++|\\.)*+("?)|[{}\[\]]', re.DOTALL)


def _text_batch(texts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).cast(pa.string())], ["raw_record"])


def json_objects(pieces: Iterator[bytes], name: str = "page") -> Iterator[bytes]:
    """The objects of an array, or those that follow one another, from the pieces of a text.

    No more is held than the object at hand and one piece. Elements that aren't objects are
    passed over.
    """
    rest, at, depth, start, top = b"", 0, 0, -1, None
    for piece in pieces:
        rest, at = rest[max(at if start < 0 else start, 0) :] + piece, at - max(at if start < 0 else start, 0)
        if start >= 0:
            start = 0
        if top is None:
            bare = rest.removeprefix(b"\xef\xbb\xbf").lstrip()
            if not bare or len(rest) < 3:
                continue
            top = 1 if bare.startswith(b"[") else 0
        while token := _TOKEN.search(rest, at):
            first = rest[token.start()]
            if first == 34 and not token[1]:
                at = token.start()  # the string goes on in the next piece
                break
            at = token.end()
            if first in b"{[":
                if depth == top and first == 123:
                    start = token.start()
                depth += 1
            elif first in b"}]":
                depth -= 1
                if start >= 0 and depth == top:
                    yield rest[start:at]
                    start = -1
        else:
            at = len(rest)
    if depth or start >= 0 or (top is None and rest.strip(b"\xef\xbb\xbf \t\r\n")):
        raise ValueError(f"{name} ends within a value")


def explode_observations(payloads: DataFrame, series: DataFrame) -> DataFrame:
    """One row per usable observation of each series document.

    ``payloads`` has (series_id, payload); ``series`` has (series_id, title, source,
    units).  Missing values ("", ".", null) and undated observations are dropped.
    """
    doc = F.from_json("payload", "observations array<struct<date:string,value:string>>")
    obs = payloads.select("series_id", F.explode(doc["observations"]).alias("o")).select(
        "series_id", F.col("o.date").alias("date"), F.col("o.value").alias("value1")
    )
    usable = truthy(F.col("date")) & truthy(F.col("value1")) & (F.col("value1") != ".")
    known = series.select(
        "series_id", "title", F.col("source").alias("underlying"), F.col("units")
    )
    return (
        obs.where(usable)
        .join(known, "series_id", "left")
        .select(
            F.concat_ws("_", "series_id", "date").alias("id"),
            F.coalesce("title", "series_id").alias("indicator"),
            "date",
            "value1",
            F.lit(None).cast("string").alias("measure1"),
            F.lit(None).cast("string").alias("measure2"),
            "units",
            F.col("underlying").alias("source"),
        )
    )


def unwrap_rate_payload(payloads: DataFrame, routes: DataFrame) -> DataFrame:
    """One row per rate object of each response, with its route attached.

    ``payloads`` has (origin, destination, container, payload).  A response is a
    list, ``{"data": [...]}``, ``{"results": [...]}`` or one object.  A response that
    is not JSON is a failed route and yields no row; ``failed_routes`` reports it.
    ``routes`` has (route_code, description, origin, destination).
    """
    doc = F.try_parse_json("payload")
    kind = F.schema_of_variant(F.col("doc"))
    items = (
        F.when(kind.startswith("ARRAY"), F.col("doc"))
        .when(_has("data"), F.try_variant_get("doc", "$.data", "variant"))
        .when(_has("results"), F.try_variant_get("doc", "$.results", "variant"))
    )
    as_list = F.coalesce(
        items.try_cast("array<variant>"),
        F.when(items.isNull() & kind.startswith("OBJECT"), F.array("doc")),
    )
    rates = (
        payloads.withColumn("doc", doc)
        .withColumn("rate", F.explode(as_list))
        .select(
            "origin",
            "destination",
            "container",
            *[_text(F.col("rate"), f) for f in _RATE_FIELDS],
        )
    )
    on = ["origin", "destination"]
    known = routes.select("route_code", "description", *on)
    return rates.join(known, on).select(
        F.col("route_code").alias("routeCode"),
        F.col("description").alias("route_description"),
        F.col("origin").alias("originPort"),
        F.col("destination").alias("destinationPort"),
        F.col("container").alias("containerType"),
        *_RATE_FIELDS,
    )


def failed_routes(payloads: DataFrame) -> DataFrame:
    """(responses, failed) over all routes; a run in which all failed is an error."""
    bad = F.try_parse_json("payload").isNull()
    return payloads.agg(
        F.count(F.lit(1)).alias("responses"), F.count_if(bad).alias("failed")
    )


class AllRoutesFailed(ValueError):
    """No route of a run gave a usable response."""


def check_routes(payloads: DataFrame) -> int:
    """The number of failed routes; an error if responses came and every one failed.

    One aggregate over the responses, before anything of the run is written.
    """
    responses, failed = failed_routes(payloads).first()
    if responses and failed == responses:
        raise AllRoutesFailed(f"all {responses} routes failed")
    return failed


_RATE_FIELDS = [
    "route",
    "tradeRoute",
    "trade_lane",
    "rateUsd",
    "rate_usd",
    "rate",
    "publishedDate",
    "published_date",
    "region",
]


def _has(key: str):
    return F.try_variant_get("doc", f"$.{key}", "variant").isNotNull()


def _text(v, field: str):
    return F.try_variant_get(v, f"$.{field}", "string").alias(field)


def scan_feed_items(
    feeds: DataFrame, phrase: str = "weekly rail traffic", fallback: str | None = None
) -> DataFrame:
    """First item of each RSS document whose title holds ``phrase`` and that has a link.

    ``feeds`` has (feed_id, xml).  Titles and links are read item by item, so an item
    without a link cannot shift its neighbours' links.  ``fallback`` is the link of a
    feed with no such item (the archive page's first link), null by default.
    """
    doc = F.from_xml("xml", f"channel struct<item:{_ITEMS}>, item {_ITEMS}")
    none = F.array().cast(_ITEMS)
    parsed = feeds.select("feed_id", doc.alias("doc")).select(
        "feed_id",
        F.concat(F.coalesce("doc.channel.item", none), F.coalesce("doc.item", none)).alias("items"),
    )
    wanted = F.filter(
        "items", lambda i: F.contains(F.lower(i["title"]), F.lit(phrase)) & truthy(i["link"])
    )
    first = F.get(wanted, F.lit(0))
    return parsed.select(
        "feed_id",
        first["title"].alias("title"),
        F.coalesce(first["link"], F.lit(fallback)).alias("link"),
    ).where(F.col("link").isNotNull())


def unescape(c):
    """Resolve the character entities that occur in feeds and links."""
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#34;", '"'),
        ("&apos;", "'"),
        ("&#39;", "'"),
        ("&#x27;", "'"),
        ("&#38;", "&"),
        ("&amp;", "&"),
    ):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c
