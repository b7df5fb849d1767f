from pyspark.sql import functions as F

from railyard.constants import BORDER_VIEWS
from railyard.operators import backfill, normalize
from railyard.plans import jobs
from railyard.sources import archives, border, store_scan
from tests.test_normalize import waybill
from tests.test_sources import archive_frame, make_zip

D1, D2, D3 = (BORDER_VIEWS[v] + "\n" for v in ("dot1", "dot2", "dot3"))


def registry(spark, members: dict):
    listed = archives.list_members(archive_frame(spark, {"a.zip": make_zip(members)}))
    known = backfill.prefer_outer_members(backfill.register_members(listed))
    picked = backfill.pick_member(known, by=["archive"]).collect()
    found = {(r["kind"], r["year"], r["month"], r["view"]): r["member"] for r in picked}
    return found, [r["error"] for r in listed.where("error IS NOT NULL").collect()]


def test_copies_lose_to_the_shorter_path(spark):
    found, errors = registry(
        spark,
        {
            "2008/Copy of January 2008/dot1_0108.csv": D1,
            "2008/January 2008/dot1_0108.csv": D1,
            "2008/January 2008/dot1_ytd_0108.csv": D1,
            "2008/December 2008/dot1_2008.csv": D1,
            "2008/March 2008/Dot2_0308.csv": D2,
        },
    )
    assert found == {
        ("monthly", 2008, 1, "dot1"): "2008/January 2008/dot1_0108.csv",
        ("ytd", 2008, 1, "dot1"): "2008/January 2008/dot1_ytd_0108.csv",
        ("monthly", 2008, 3, "dot2"): "2008/March 2008/Dot2_0308.csv",
    }
    assert errors == []


def test_inner_archives_count_only_without_outer_months(spark):
    bundle = make_zip({"dot1_0111.csv": D1, "dot2_0111.csv": D2})
    both = {"Data Files/dot1_0111.csv": D1, "Zip Files/dot1_2011.zip": bundle}
    assert registry(spark, both)[0] == {
        ("monthly", 2011, 1, "dot1"): "Data Files/dot1_0111.csv"
    }
    only = {"2017/Jan 2017.zip": bundle, "2017/Feb 2017.zip": b"this is not a zip archive"}
    found, errors = registry(spark, only)
    assert set(found) == {("monthly", 2011, 1, "dot1"), ("monthly", 2011, 1, "dot2")}
    assert errors and errors[0].startswith("inner zip unreadable")


def test_legacy_names_are_classified_by_header(spark):
    found, _ = registry(
        spark,
        {f"Aug/TransBorder_3_0816 ({i}).csv": h for i, h in ((1, D3), (2, D1), (3, D2))},
    )
    assert {k[3]: v[-6] for k, v in found.items()} == {"dot3": "1", "dot1": "2", "dot2": "3"}


def test_targets(spark):
    got = backfill.parse_targets(spark, ["2007", "2009-2011", "2017-05"]).collect()
    want = {(y, m) for y in (2007, 2009, 2010, 2011) for m in range(1, 13)} | {(2017, 5)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert backfill.parse_targets(spark, []).count() == 0


def test_asof(spark):
    releases = spark.createDataFrame(
        [(2025, 12, "dec"), (2026, 1, "jan"), (2026, 2, "feb"), (2026, 2, "feb")],
        "year int, month int, url string",
    )
    asked = spark.createDataFrame(
        [(2026, 2), (2026, 1), (2025, 10), (None, None), (2031, 1)], "year int, month int"
    )
    got = {(r["year"], r["month"]): r["url"] for r in backfill.asof_release(asked, releases).collect()}
    assert got == {(2026, 2): "feb", (2026, 1): "jan", (2025, 10): None, (None, None): "feb",
                   (2031, 1): "feb"}
    near = backfill.asof_release(asked, releases, max_years=5).collect()
    assert {r["year"]: r["url"] for r in near}[2031] is None


def test_asof_agrees_with_brute_force_per_key(spark):
    rel = [(f"k{i % 3}", 2000 + i // 5, 1 + (i * 7) % 12, f"u{i}") for i in range(40)]
    req = [(f"k{i % 4}", 1999 + i // 6, 1 + (i * 5) % 12) for i in range(60)]
    releases = spark.createDataFrame(rel, "k string, year int, month int, url string")
    asked = spark.createDataFrame(req, "k string, year int, month int")
    got = backfill.asof_release(asked, releases, by=["k"]).collect()
    assert len(got) == len(req)
    for r in got:
        past = [(y, m, u) for k, y, m, u in rel if k == r["k"] and (y, m) <= (r["year"], r["month"])]
        assert (r["release_year"], r["release_month"], r["url"]) == max(past, default=(None,) * 3)


def border_line(view, value, month):
    names = BORDER_VIEWS[view].split(",")
    fixed = {"TRDTYPE": "1", "COUNTRY": "1220", "VALUE": str(value), "MONTH": month, "YEAR": "2008"}
    return ",".join(fixed.get(n, "") for n in names) + "\n"


def test_backfill_job_recovers_and_reports(spark, tmp_path):
    good = {
        "2008/March/dot1_0308.csv": D1 + border_line("dot1", 10, "03"),
        "2008/March/dot2_0308.csv": D2 + border_line("dot2", 20, "03") * 30,
        "2008/March/dot3_0308.csv": D3 + border_line("dot3", 30, "03") * 30,
        "2008/April/dot2_ytd_0408.csv": D2
        + border_line("dot2", 1, "02") + border_line("dot2", 300, "03") + border_line("dot2", 4, "04"),
        "2008/May/dot1_0508.csv": D1 + border_line("dot1", 50, "05"),
    }
    content = bytearray(make_zip(good))
    for name in (b"dot2_0308.csv", b"dot3_0308.csv"):
        at = content.index(name) + len(name) + 200
        content[at] ^= 0xFF
    frame = archive_frame(spark, {"2008.zip": bytes(content)})
    root = str(tmp_path)
    written, report = jobs.backfill_transborder(spark, frame, root)
    rows = store_scan.scan_table(spark, root, "transborder_freight").collect()
    assert written == len(rows) == 3
    assert {(r["source_file"], r["month"], r["value_usd"]) for r in rows} == {
        ("dot1", 3, 10.0), ("dot2", 3, 300.0), ("dot1", 5, 50.0)
    }
    status = {(r["month"], r["view"]): r["status"] for r in report.collect()}
    assert status == {(3, "dot2"): "recovered", (3, "dot3"): "unrecoverable",
                      (5, "dot2"): "absent", (5, "dot3"): "absent"}
    again, _ = jobs.backfill_transborder(spark, frame, root)
    assert again == 0
    assert jobs.backfill_transborder(spark, frame, root, ["2008-05"], force=True)[0] == 1


def test_missing_partitions(spark):
    wanted = spark.createDataFrame([(2020, 1), (2020, 2)], "year int, month int")
    stored = spark.createDataFrame([(2020, 1)], "year int, month int")
    assert [tuple(r) for r in backfill.missing_partitions(wanted, stored).collect()] == [(2020, 2)]
    assert backfill.missing_partitions(wanted, stored, force=True).count() == 2
    assert backfill.except_months(wanted, stored).agg(F.max("month")).first()[0] == 2


def test_a_line_is_parsed_once(spark):
    line = "archive string, member string, line_no bigint, line binary, encoding string, error string"
    lines = spark.createDataFrame([("a", "m", 1, b"1220,x,1,01,2024,5", "UTF-8", None)], line)
    head = "archive string, member string, header binary, view string"
    heads = spark.createDataFrame([("a", "m", b"COUNTRY,other,TRDTYPE,MONTH,YEAR,VALUE", "dot1")], head)
    rows = border.parse_csv_lines(lines, heads)
    typed = normalize.norm_transborder(rows)
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    row = typed.first()
    assert (row["country"], row["value_usd"], row["us_state"]) == ("CA", 5.0, None)
    assert rows.first()["SHIPWT"] is None


def test_a_member_is_matched_once(spark):
    names = ["a/dot1_0108.csv", "dot2_ytd_0308.csv", "x.csv", None]
    members = spark.createDataFrame([("a.zip", n, False) for n in names], "archive string, member string, inner boolean")
    found = backfill.register_members(members)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 3
    assert {(r["kind"], r["view"], r["month"]) for r in found.collect()} == {("monthly", "dot1", 1), ("ytd", "dot2", 3)}


def test_waybill_lines_are_dealt_before_they_are_parsed(spark, tmp_path):
    lines = [waybill(waybill_date=f"0101{y:02d}") for y in range(40)] * 2
    lines += [waybill()[:100], waybill(car_ownership="é", waybill_date="020105")]
    rows = [(bytearray(x, "latin-1"),) for x in lines]
    df = spark.createDataFrame(rows, "line binary").coalesce(1)
    # Where a row is parsed: all in the task that read the lines, if they are not dealt before.
    task = F.timestamp_seconds(F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = jobs.backfill_waybills(spark, {2024: df}, str(tmp_path), ingested_at=task)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert done == {2024: {"written": 81, "dropped": 1, "skipped": 0}}
    stored = store_scan.scan_table(spark, str(tmp_path), "waybill_shipments")
    counts = {r["y"]: r["count"] for r in stored.groupBy(F.year("snapshot_date").alias("y")).count().collect()}
    assert counts == {2000 + y: 3 if y == 5 else 2 for y in range(40)}
    assert stored.select("ingested_at").distinct().count() > 1
