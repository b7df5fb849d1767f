import io
import json
import tempfile
import tracemalloc
import zipfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from railyard.constants import BORDER_VIEWS, INDEX_SERIES
from railyard.operators import lookups
from railyard.operators import normalize as N
from railyard.sources import archives, border, cube, feeds, releases

def release_page(week: int, ended: str, records: dict[str, tuple]) -> str:
    """A release page with invented figures, in the shape of the feed."""
    head = ["U.S. Rail Traffic1", f"Week {week}, 2031 – Ended {ended}, 2031"]
    columns = ["This Week", "Year-To-Date", "Cars", "vs 2030", "Cumulative", "Avg/wk2", "vs 2030"]
    body = [str(x) for label, figures in records.items() for x in (label, *figures)]
    return "\n".join([*head, *columns, *body, "1 A note.", "2 Another note.", "Trends, 2031 vs 2030", ""])


FIGURES = {
    "Lumber": ("4,321", "9.5%", "40,110", "4,010", "0.5%"),
    "Sand": ("908", "-12.0%", "8,000", "800", "-3.5%"),
    "Everything": ("5,229", "5.0%", "48,110", "4,810", "-0.1%"),
}
PAGE = release_page(10, "March 8", FIGURES)


def make_zip(members: dict[str, bytes | str]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return buffer.getvalue()


_FOLDERS = []


def archive_frame(spark, zips: dict[str, bytes]):
    """(archive) of the zips, written to a new folder."""
    _FOLDERS.append(tempfile.TemporaryDirectory())
    rows = []
    for name, content in zips.items():
        path = Path(_FOLDERS[-1].name, name)
        path.write_bytes(content)
        rows.append((f"file:{path}",))
    return spark.createDataFrame(rows, "archive string")


def test_release_page(spark):
    pages = spark.createDataFrame(
        [
            (1, 0, PAGE),
            (1, 1, PAGE.replace("U.S.", "Canadian").replace("Rail", "Rail")),
            (1, 4, PAGE),
            (2, 0, "no title or rows here"),
            (3, 0, PAGE.replace("March 8", "March 38")),
        ],
        "doc_id long, page_no int, text string",
    )
    rows = releases.parse_release_pages(pages.where("doc_id <> 1 OR page_no <> 1"))
    assert rows.count() == len(FIGURES)
    assert releases.parse_release_pages(pages, max_pages=None).count() == 3 * len(FIGURES)
    got = {r["category"]: r for r in N.norm_weekly_traffic(rows).collect()}
    assert set(got) == set(FIGURES)
    for label, (cars, change, total, mean, total_change) in FIGURES.items():
        row = got[label]
        assert row["this_week_cars"] == int(cars.replace(",", ""))
        assert row["ytd_cars"] == int(total.replace(",", ""))
        assert row["ytd_avg_week_cars"] == int(mean.replace(",", ""))
        assert row["this_week_yoy_pct"] == float(change.rstrip("%"))
        assert row["ytd_yoy_pct"] == float(total_change.rstrip("%"))
        assert (row["region"], row["week_number"], row["year"]) == ("US", 10, 2031)
        assert row["snapshot_date"] == date(2031, 3, 8)


def cube_doc(value: dict) -> str:
    def dim(*codes):
        return {"category": {"index": {c: i for i, c in enumerate(codes)},
                             "label": {c: c.lower() for c in codes}}}

    return json.dumps(
        {"dimension": {"freq": dim("A"), "unit": dim("THS_T", "MIO_TKM"), "geo": dim("DE", "FR"),
                       "time": dim("2004", "2005")}, "value": value}
    )


def test_cube(spark):
    docs = [
        cube_doc({str(i): 100 + i for i in range(8)}),
        cube_doc({"0": ":", "1": "55", "2": None, "3": 7.5, "x": 1, "99": 1}),
        json.dumps({"dimension": {}, "value": {"0": 1}}),
        "not json",
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc int, payload string")
    rows = cube.decode_jsonstat(df, keep=["doc"]).collect()
    assert sum(r["doc"] == 0 for r in rows) == 8
    first = next(r for r in rows if r["doc"] == 0 and r["value"] == 100)
    assert (first["country_code"], first["country_name"], first["unit"], first["period"]) == (
        "DE", "de", "THS_T", "2004"
    )
    assert [(r["country_code"], r["period"], r["value"]) for r in rows if r["doc"] == 1] == [
        ("FR", "2005", 7.5)
    ]
    assert not [r for r in rows if r["doc"] > 1]


def test_observations_and_routes(spark):
    payload = json.dumps({"observations": [
        {"date": "2026-01-01", "value": "1.009"}, {"date": "2026-02-01", "value": "."},
        {"date": "", "value": "2"}, {"date": "2026-03-01", "value": "0"}]})
    df = spark.createDataFrame([("TRUCKD11", payload), ("ZZ", payload)], "series_id string, payload string")
    rows = feeds.explode_observations(df, lookups.series_dimension(spark)).collect()
    assert len(rows) == 4
    assert {r["indicator"] for r in rows} == {"Truck Tonnage Index", "ZZ"}
    assert "TRUCKD11_2026-03-01" in {r["id"] for r in rows}

    one = '{"rateUsd": 4500}'
    bodies = [f"[{one},{one}]", f'{{"data":[{one}]}}', f'{{"results":[{one}]}}', one, "<html>"]
    responses = spark.createDataFrame(
        [("CNSHA", "USLAX", "40GP", b) for b in bodies],
        "origin string, destination string, container string, payload string",
    )
    rates = feeds.unwrap_rate_payload(responses, lookups.route_dimension(spark)).collect()
    assert len(rates) == 5 and {r["routeCode"] for r in rates} == {"FBX01"}
    assert {r["rateUsd"] for r in rates} == {"4500"}
    assert tuple(feeds.failed_routes(responses).first()) == (5, 1)


def test_known_routes_do_not_move_the_rates(spark):
    response = spark.range(1).selectExpr("'CNSHA' AS origin", "'USLAX' AS destination", "'40GP' AS container", "'{}' AS payload")
    rates = feeds.unwrap_rate_payload(response, lookups.route_dimension(spark))
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert rates.count() == 1
    assert lookups.series_dimension(spark).count() == len(INDEX_SERIES)


def test_feed_items_and_links(spark):
    item = "<item><title>{}</title>{}</item>"
    link = "<link>https://x/{}</link>"
    xml = "<rss>" + item.format("News", link.format(1)) + item.format("Weekly rail traffic", "")
    xml += item.format("<![CDATA[Weekly Rail Traffic]]>", link.format(3)) + "</rss>"
    df = spark.createDataFrame([(1, xml), (2, "<rss></rss>")], "feed_id int, xml string")
    assert [tuple(r) for r in feeds.scan_feed_items(df).collect()] == [
        (1, "Weekly Rail Traffic", "https://x/3")
    ]
    rows = feeds.scan_feed_items(df, fallback="https://x/archive").collect()
    assert {r["feed_id"]: r["link"] for r in rows}[2] == "https://x/archive"

    html = (
        '<a href="/a/old.pdf">a</a> <a href="/b.pdf?x=1">b</a> https://h/first.PDF?utm=1 '
        '"https://h/2026-railtraffic.pdf" https://h/first.PDF'
    )
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    urls = [r["url"] for r in releases.extract_links(pages).orderBy("rank").collect()]
    assert urls == ["https://h/2026-railtraffic.pdf", "https://h/first.PDF", "/a/old.pdf"]


def file_name(row) -> str:
    return row["archive"].rpartition("/")[2]


def test_archive_lines(spark):
    latin = "1,caf\xe9".encode("latin-1")
    zips = {
        "good.zip": make_zip({
            "a.csv": b"\xef\xbb\xbfH1,H2\r\n1,\"two\nlines\"\r\n", "b.CSV": b"H1\n" + latin,
            "c.pdf": b"no"}),
        "bad.zip": b"this is not a zip",
        "none.zip": make_zip({"c.pdf": b"no"}),
    }
    broken = bytearray(make_zip({"x.csv": b"H1\n" + b"1\n" * 50}))
    broken[45] ^= 0xFF
    zips["broken.zip"] = bytes(broken)
    rows = archives.scan_archive_members(archive_frame(spark, zips), [".csv"], True).collect()
    good = [(r["member"], r["line_no"], bytes(r["line"]), r["encoding"]) for r in rows
            if file_name(r) == "good.zip"]
    assert sorted(good) == [
        ("a.csv", 0, b"H1,H2", "UTF-8"),
        ("a.csv", 1, b'1,"two\nlines"', "UTF-8"),
        ("b.CSV", 0, b"H1", "ISO-8859-1"),
        ("b.CSV", 1, latin, "ISO-8859-1"),
    ]
    errors = {file_name(r): r["error"] for r in rows if r["error"]}
    assert set(errors) == {"bad.zip", "none.zip", "broken.zip"}
    assert "unreadable" in errors["broken.zip"] and "no data member" in errors["none.zip"]
    assert len([r for r in rows if file_name(r) == "broken.zip"]) == 1


def test_archive_beyond_two_gigabytes_spreads_over_tasks(spark, tmp_path):
    path = tmp_path / "large.ZIP"
    with open(path, "wb") as f:
        f.truncate(5 * 2**29)  # a hole before the first member takes no disk
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as z:
        for i in range(50):
            z.writestr(f"m{i:02}.txt", "".join(f"{i};{j}\r\n" for j in range(300)))
        z.writestr("no.pdf", "x")
        z.writestr("packed.txt", "bz\ntwo", zipfile.ZIP_BZIP2)
        z.writestr("odd.txt", "lz", zipfile.ZIP_LZMA)
    found = archives.find_archives(spark, str(tmp_path))
    assert [r["length"] > 2**31 for r in found.collect()] == [True]
    rows = archives.scan_archive_members(found, [".txt"]).collect()
    want = {(f"m{i:02}.txt", j, f"{i};{j}".encode()) for i in range(50) for j in range(300)}
    want |= {("packed.txt", 0, b"bz"), ("packed.txt", 1, b"two")}
    assert {(r["member"], r["line_no"], bytes(r["line"])) for r in rows if not r["error"]} == want
    assert [(r["member"], "compression method" in r["error"]) for r in rows if r["error"]] == [("odd.txt", True)]
    listing = spark.createDataFrame(archives.list_members(found).collect(), archives._LISTING)
    lines = archives.scan_chosen_members(listing.where("name like 'm%'"))
    used = lines.select("member", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(used) == 50 and len({r["task"] for r in used}) > 1


def test_members_of_inner_archives(spark):
    bodies = {f"d{i}.csv": "H\n" + "".join(f"{i},{j}\n" for j in range(40_000 * (i == 1) + 5)) for i in range(4)}
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in bodies.items():
            z.writestr(name, body)
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("top.csv", "T\n1")
        z.writestr("in/side.zip", inner.getvalue())
        z.writestr("broken.zip", b"no zip")
        z.writestr("folder/", b"")
    listing = archives.list_members(archive_frame(spark, {"o.zip": outer.getvalue()})).collect()
    names = {r["member"]: (r["member_no"], r["inner"], r["header"] and bytes(r["header"])) for r in listing if not r["error"]}
    assert names == {"top.csv": (0, False, b"T"), "in/side.zip": (1, False, None), "broken.zip": (2, False, None)} | {
        f"in/side.zip!/d{i}.csv": (3 + i, True, b"H") for i in range(4)
    }
    assert [r["member"] for r in listing if r["error"]] == ["broken.zip"]
    chosen = spark.createDataFrame([r for r in listing if r["within"]], archives._LISTING)
    rows = archives.scan_chosen_members(chosen).orderBy("member", "line_no").collect()
    got = {}
    for r in rows:
        got[r["member"]] = got.get(r["member"], "") + bytes(r["line"]).decode() + "\n"
    assert got == {f"in/side.zip!/{n}": b for n, b in bodies.items()}


def test_dense_members_inflate_in_chunks():
    body = b"0,1\n" * (6 << 20)
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", method) as z:
            z.writestr("m.csv", body)
            info = z.infolist()[0]
        place = (None, "m.csv", info.header_offset, info.compress_size, method, info.CRC, False)
        sizes, got = [], io.BytesIO()
        for chunk in archives._inflated(packed, place):
            sizes.append(len(chunk))
            got.write(chunk)
        assert got.getvalue() == body and max(sizes) <= 1 << 20


def test_quoted_fields_over_chunks(monkeypatch):
    body = b'a,"x\ny""\n",b\n1,2\n"open'
    for size in range(1, len(body) + 1):
        chunks = [body[i : i + size] for i in range(0, len(body), size)]
        got = [line for lines in archives._lines(iter(chunks), True) for line in lines]
        assert got == [b'a,"x\ny""\n",b', b"1,2", b'"open'], size
    marked = b"\xef\xbb\xbfa\r\nb"
    for size in range(1, len(marked) + 1):
        chunks = [marked[i : i + size] for i in range(0, len(marked), size)]
        assert [x for xs in archives._lines(iter(chunks), False) for x in xs] == [b"a", b"b"]


def csv_row(names: list[str], **values: str) -> str:
    return ",".join(values.get(n, "") for n in names)


def test_border_csv_binds_columns_by_name(spark, tmp_path):
    first = BORDER_VIEWS["dot1"].split(",")
    swapped = [*first[1:], "EXTRA", first[0]]
    third = BORDER_VIEWS["dot3"].split(",")
    common = {"COUNTRY": "1220", "MONTH": "03", "YEAR": "2031"}
    one = common | {"TRDTYPE": "1", "USASTATE": "TX", "DISAGMOT": "6", "VALUE": "100"}
    folder = tmp_path / "m"
    folder.mkdir()

    def land(name: str, names: list[str], *rows: dict) -> None:
        lines = [",".join(names), *(csv_row(names, **r) for r in rows)]
        (folder / name).write_text("\n".join(lines) + "\n")

    land("dot1_0331.csv", ["\ufeff" + first[0], *first[1:]])
    (folder / "dot1_0331.csv").write_text("\ufeff" + ",".join(first) + "\n" + csv_row(first, **one) + "\n")
    land("dot1_0431.csv", swapped, one | {"MONTH": "04", "VALUE": "7", "EXTRA": "x"})
    land("dot1_ytd_0431.csv", first, one, one | {"MONTH": "04", "VALUE": "7"})
    land("Dot3_0331.csv", third, common | {"TRDTYPE": "2", "COUNTRY": "2010", "DISAGMOT": "1", "VALUE": "3", "COMMODITY2": "44"})
    odd = tmp_path / "a [b]{c} *"
    odd.mkdir()
    (odd / "dot1_0531.csv").write_text(",".join(first) + "\n" + csv_row(first, **one | {"VALUE": "8"}) + "\n")
    (odd / "dot2_0531.csv").write_text("no header\n1,2\n")
    scan = border.scan_transborder_csv(spark, str(tmp_path))
    plan = scan._jdf.queryExecution().toString()
    # Three layouts; a byte-order mark makes no other. Each is one scan, and no row is joined.
    assert "Join" not in plan and plan.count("FileScan csv") == len({tuple(first), tuple(swapped), tuple(third)})
    rows = N.norm_transborder(scan).collect()
    got = sorted((r["source_file"], r["value_usd"], r["trade_type"], r["us_state"], r["mode"]) for r in rows)
    assert got == [
        ("dot1", 7.0, "import", "TX", "rail"),
        ("dot1", 8.0, "import", "TX", "rail"),
        ("dot1", 100.0, "import", "TX", "rail"),
        ("dot3", 3.0, "export", None, "vessel"),
    ]
    assert {r["commodity_2digit"] for r in rows if r["source_file"] == "dot3"} == {"44"}

    lines = spark.createDataFrame(
        [("z", "m", 0, b"h", "UTF-8", None), ("z", "m", 1, b"2026,7,1220,1,01", "UTF-8", None)],
        "archive string, member string, line_no long, line binary, encoding string, error string",
    )
    heads = spark.createDataFrame(
        [("z", "m", b"YEAR,VALUE,COUNTRY,TRDTYPE,MONTH", "dot1")],
        "archive string, member string, header binary, view string",
    )
    row = N.norm_transborder(border.parse_csv_lines(lines, heads)).first()
    assert (row["value_usd"], row["country"], row["snapshot_date"]) == (7.0, "CA", date(2026, 1, 31))


def test_a_stray_quote_keeps_its_line(spark):
    body = "H1,H2\n" + 'A"K,1\n' + '"x ""y""\nz",2\n' + "".join(f"r{i},3\n" for i in range(4))
    rows = archives.scan_archive_members(archive_frame(spark, {"q.zip": make_zip({"q.csv": body})}), [".csv"])
    lines = [bytes(r["line"]).decode() for r in rows.orderBy("line_no").collect()]
    assert lines == ["H1,H2", 'A"K,1', '"x ""y""\nz",2', "r0,3", "r1,3", "r2,3", "r3,3"]


def test_views_by_header(spark):
    df = spark.createDataFrame([(v, h) for v, h in BORDER_VIEWS.items()], "v string, h string")
    got = df.select("v", archives.classify_view(F.col("h")).alias("g")).collect()
    assert all(r["v"] == r["g"] for r in got)


def test_json_page_in_pieces():
    page = b'[{"a":1},{"b":"}{\\"]"} , 5, "x{", [ {"no":1} ], {"c":{"d":[1,{}]}}]'
    objects = [b'{"a":1}', b'{"b":"}{\\"]"}', b'{"c":{"d":[1,{}]}}']
    for size in range(1, len(page) + 1):
        pieces = [page[i : i + size] for i in range(0, len(page), size)]
        assert list(feeds.json_objects(iter(pieces))) == objects
    for broken in (b'[{"a":1}', b'[{"a":"x', b'{"a":1'):
        with pytest.raises(ValueError, match="ends within a value"):
            list(feeds.json_objects(iter([broken])))
    # Memory doesn't grow with the page.
    held = 0

    def endless():
        yield b"["
        for i in range(30_000):
            yield b'{"k":%d,"t":"' % i + b"x" * 1000 + b'"},'
        yield b"{}]"

    tracemalloc.start()
    count = sum(1 for _ in feeds.json_objects(endless()))
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 30_001 and held < 2_000_000


def test_json_feed_keeps_whole_objects(spark, tmp_path):
    (tmp_path / "p1.json").write_text('[{"a": 1.50, "extra": {"b": [1]}},\n {"a": null}]')
    (tmp_path / "p2.json").write_text('{"a": "x", "more": true}')
    rows = {r["a"]: json.loads(r["raw_record"]) for r in feeds.scan_json_feed(spark, str(tmp_path), ["a", "z"]).collect()}
    assert rows == {"1.5": {"a": 1.5, "extra": {"b": [1]}}, None: {"a": None}, "x": {"a": "x", "more": True}}
