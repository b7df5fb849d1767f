import json
import math
import random
import statistics
import time
from datetime import date, datetime
from pathlib import Path
from threading import Timer

import pytest
from pyspark.sql import functions as F

from railyard.constants import BORDER_COLUMNS
from railyard.operators import dedup, filters, profile, quality, report
from railyard.operators import normalize as N
from railyard.plans import jobs, profiles
from railyard.schemas import TABLES, table
from railyard.session import path_exists
from railyard.sinks import store
from railyard.sources import store_scan
from railyard.streaming import ingest
from railyard.streaming.ingest import incremental_ingest

AS_OF = date(2026, 7, 15)


def stamp(day: int):
    return F.lit(datetime(2026, 7, day)).cast("timestamp")


def cars(feed, *rows, day=1):
    raw = feed(*[dict(zip(("date", "railroad", "carloads"), r, strict=True)) for r in rows])
    return N.norm_carloadings(raw, AS_OF, ingested_at=stamp(day))


def stored(spark, root, name="rail_carloadings"):
    rows = store_scan.scan_table(spark, root, name).collect()
    return sorted((str(r["snapshot_date"]), r["railroad"], r["carloads"]) for r in rows)


def test_rows_are_filed_under_their_own_day(spark, feed, tmp_path):
    root = str(tmp_path)
    first = cars(feed, ("2020-01-15", "A", "1"), ("2021-06-01", "B", "2"))
    assert store.write_day_partitions(first, root, "rail_carloadings", AS_OF) == 2
    folders = {p.name for p in (tmp_path / "freight" / "rail_carloadings").iterdir()}
    assert {"p_year=2020", "p_year=2021"} <= folders
    store.write_day_partitions(cars(feed, ("2020-01-15", "C", "3")), root, "rail_carloadings")
    assert stored(spark, root) == [("2020-01-15", "C", 3.0), ("2021-06-01", "B", 2.0)]
    assert [r[0] for r in store_scan.list_tables(spark, root).collect()] == ["rail_carloadings"]
    inventory = {r["table"]: r["rows"] for r in store.store_inventory(spark, root).collect()}
    assert inventory["rail_carloadings"] == 2 and inventory["waybill_shipments"] == 0


def test_no_rows_no_files_and_unknown_table(spark, feed, tmp_path):
    root = str(tmp_path)
    assert store.write_day_partitions(cars(feed, ("x", "A", "-1")), root, "rail_carloadings") == 0
    assert stored(spark, root) == []
    assert store.merge_year_partitions(
        spark, N.norm_carrier_census(feed({"dot_number": ""}), AS_OF), root, "motor_carrier_census"
    ) == 0
    with pytest.raises(ValueError, match="Unknown table"):
        store.write_day_partitions(cars(feed, ("x", "A", "1")), root, "no_such_table")


def census(feed, day, *carriers):
    raw = feed(*[{"dot_number": n, "mcs150_date": d} for n, d in carriers])
    return N.norm_carrier_census(raw, AS_OF, ingested_at=stamp(day))


def test_years_merge_and_keep_the_newest(spark, feed, tmp_path):
    root, name = str(tmp_path), "motor_carrier_census"
    first = census(feed, 1, ("1", "01-JAN-24"), ("1", "01-JAN-24"), ("2", "01-JUN-24"))
    assert store.merge_year_partitions(spark, first, root, name) == 3
    assert store_scan.scan_table(spark, root, name).count() == 3  # a first write keeps copies
    second = census(feed, 2, ("2", "01-JUN-24"), ("3", "02-JUN-24"), ("4", "02-JUN-23"))
    assert store.merge_year_partitions(spark, second, root, name) == 3
    rows = store_scan.scan_table(spark, root, name).orderBy("dot_number").collect()
    assert [(r["dot_number"], r["ingested_at"].day) for r in rows] == [
        ("1", 1), ("2", 2), ("3", 2), ("4", 2)
    ]
    with pytest.raises(ValueError):
        store.merge_year_partitions(spark, first, root, "rail_carloadings")


def test_two_feeds_share_a_day(spark, feed, tmp_path):
    root = str(tmp_path)
    raw = feed({"id": "a", "indicator": "x", "value1": "1", "date": "2026-07-01"})
    for source in ("one", "two", "one"):
        store.write_day_partitions(N.norm_indicators(raw, source), root, "freight_indicators")
    rows = store_scan.scan_table(spark, root, "freight_indicators").collect()
    assert sorted(r["source"] for r in rows) == ["one", "two"]


def test_year_column_survives_its_folder(spark, feed, tmp_path):
    rows = N.norm_weekly_traffic(
        feed({"region": "US", "category": "Coal", "week_number": "53", "year": "2026",
              "week_end_date": "2027-01-02", "this_week_cars": "1", "ytd_cars": "2"})
    )
    store.write_day_partitions(rows, str(tmp_path), "aar_weekly_traffic")
    assert store_scan.scan_table(spark, str(tmp_path), "aar_weekly_traffic").first()["year"] == 2026


def test_corrupt_files_are_skipped(spark, feed, tmp_path):
    root = str(tmp_path)
    store.write_day_partitions(cars(feed, ("2020-01-15", "A", "1")), root, "rail_carloadings")
    folder = next((tmp_path / "freight" / "rail_carloadings").rglob("p_day=15"))
    (folder / "junk.parquet").write_bytes(b"not parquet at all")
    assert stored(spark, root) == [("2020-01-15", "A", 1.0)]


def test_date_range_prunes_folders(spark, feed, tmp_path):
    root = str(tmp_path)
    rows = [(f"2020-{m:02d}-15", "A", str(m)) for m in range(1, 7)]
    store.write_day_partitions(cars(feed, *rows), root, "rail_carloadings")
    df = store_scan.scan_table(spark, root, "rail_carloadings", with_partitions=True)
    kept = filters.filter_date_range(df, "snapshot_date", date(2020, 2, 1), date(2020, 3, 15))
    assert kept.agg(F.sum("carloads")).first()[0] == 5.0
    assert "PartitionFilters: [isnotnull(p_year" in kept._jdf.queryExecution().toString()
    assert filters.filter_date_range(df, "snapshot_date", None, date(2020, 1, 1)) is df


def test_dedup_treats_null_and_nan_as_equal(spark):
    nan = float("nan")
    rows = [(None, nan, 1), (None, nan, 2), ("a", 1.0, 1), ("a", -0.0, 1), ("a", 0.0, 3)]
    df = spark.createDataFrame(rows, "k string, v double, ingested_at int")
    got = sorted((r["k"] or "", str(abs(r["v"])), r["ingested_at"]) for r in dedup.dedup_keep_latest(df).collect())
    assert got == [("", "nan", 2), ("a", "0.0", 3), ("a", "1.0", 1)]


def test_describe_is_exact(spark):
    rng = random.Random(7)
    for values in (
        [rng.gauss(0, 1) for _ in range(2000)],
        [1.0] * 900 + [float(i) for i in range(101)],
        [5.0],
        [1.0, 2.0],
    ):
        df = spark.createDataFrame([(v, None) for v in values], "v double, w double")
        # Few bins must change the cost only.
        row = {r["column"]: r for r in profile.describe_numeric(df, bins=20).collect()}["v"]
        assert row["count"] == len(values) and row["min"] == min(values) and row["max"] == max(values)
        if len(values) > 1:
            want = statistics.quantiles(values, n=4, method="inclusive")
            assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(want)
            assert row["std"] == pytest.approx(statistics.stdev(values))


def test_profile_counts_nan_as_missing(spark):
    rows = [("a", 1.0), ("a", float("nan")), (None, None), ("b", 2.0)]
    df = spark.createDataFrame(rows, "s string, v double")
    got = {r["column"]: r for r in profile.profile_columns(df).collect()}
    assert (got["s"]["non_null"], got["s"]["null_pct"], got["s"]["unique"]) == (3, 25.0, 2)
    assert (got["v"]["non_null"], got["v"]["null_pct"], got["v"]["unique"]) == (2, 50.0, None)
    approx = {r["column"]: r for r in profile.profile_columns(df, approx=True).collect()}
    assert approx["s"]["unique"] == 2


def test_reports_leave_null_groups_out(spark):
    df = spark.createDataFrame(
        [("A", 1.0), ("A", None), (None, 5.0), ("B", None)], "railroad string, carloads double"
    )
    got = {r["railroad"]: r["carloads"] for r in report.carloads_by_railroad(df).collect()}
    assert got == {"A": 1.0, "B": 0.0}


def test_jobs_isolate_failures_and_summarise(spark, feed, tmp_path):
    root = str(tmp_path)

    def broken(_spark, _day):
        raise RuntimeError("down")

    good = jobs.Fetched({"rail_carloadings": cars(feed, ("2020-01-15", "A", "1"))})
    soft = jobs.Fetched({"rail_carloadings": cars(feed, ("2020-01-16", "B", "2"))}, False, "partial")
    registry = {
        "good": lambda *_: good,
        "soft": lambda *_: soft,
        "broken": broken,
        "unset": lambda *_: jobs.Fetched(),
    }
    jobs.log.disabled = True
    result = jobs.run_ingest(spark, registry, root)
    assert not result["success"] and result["sources_failed"] == ["soft", "broken"]
    assert result["total_records_written"] == 2
    (tmp_path / "pipeline_runs" / "broken.json").write_text("{not json")
    (run,) = store_scan.scan_run_summaries(spark, root).collect()
    assert run["run_id"] == result["run_id"] and run["sources_succeeded"] == ["good", "unset"]
    assert run["total_records_written"] == 2 and len(run["errors"]) == 2
    with pytest.raises(ValueError, match="extra, typo"):
        jobs.choose(registry, ["typo", "good", "extra"])
    with pytest.raises(ValueError):
        jobs.choose(registry, [])
    assert jobs.choose(registry, ["unset", "good"]) == ["good", "unset"]
    at = datetime(2031, 1, 1)
    assert len({jobs.new_run_name(at) for _ in range(50)}) == 50


def test_a_merge_over_a_damaged_file_fails(spark, feed, tmp_path):
    root = str(tmp_path)
    census = N.norm_carrier_census(feed(*[{"dot_number": str(i)} for i in range(5)]), AS_OF, ingested_at=stamp(1))
    store.merge_year_partitions(spark, census, root, "motor_carrier_census")
    (victim,) = (tmp_path / "freight" / "motor_carrier_census").rglob("*.parquet")
    whole = victim.read_bytes()
    victim.write_bytes(whole[: len(whole) // 2])
    (victim.parent / f".{victim.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="."):
        store.merge_year_partitions(spark, census.limit(1), root, "motor_carrier_census")
    assert victim.exists()
    with pytest.raises(Exception, match="."):
        store.export_compacted(spark, root, str(tmp_path / "out"), ["motor_carrier_census"])
    assert store_scan.scan_table(spark, root, "motor_carrier_census").count() == 0


def test_reports_read_only_what_they_need(spark, feed):
    raw = feed({c: "1" for c in [*BORDER_COLUMNS, "source_file"]})
    plan = report.value_by_mode(N.norm_transborder(raw).where("source_file = 'dot1'"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in text and "CANPROV" not in text.split("LogicalRDD")[0]
    assert text.index("source_file") > text.index("Generate")


def test_stream_keeps_days_whole_and_skips_seen_files(spark, feed, tmp_path):
    landing, root, check = (str(tmp_path / x) for x in ("in", "store", "check"))
    names = ["date", "railroad", "carloads"]

    def land(*rows):
        raw = feed(*[dict(zip(names, r, strict=True)) for r in rows], columns=names)
        raw.coalesce(1).write.mode("append").parquet(landing)

    def load():
        return incremental_ingest(
            spark, landing, feed({}, columns=names).schema,
            lambda b: N.norm_carloadings(b, AS_OF, ingested_at=stamp(1)), root,
            "rail_carloadings", check,
        )

    land(("2020-01-15", "A", "1"))
    assert load() == 1
    land(("2020-01-15", "B", "2"), ("2020-01-16", "C", "3"))
    assert load() == 2
    assert load() == 0
    assert [r[1] for r in stored(spark, root)] == ["A", "B", "C"]


def test_export_compacts_and_counts(spark, feed, tmp_path):
    root, out = str(tmp_path / "s"), str(tmp_path / "o")
    store.write_day_partitions(
        cars(feed, ("2020-01-15", "A", "1"), ("2020-01-15", "A", "1")), root, "rail_carloadings"
    )
    stats = store.export_compacted(spark, root, out).collect()
    assert [(r["table"], r["rows"]) for r in stats] == [("rail_carloadings", 1)]
    assert stats[0]["bytes"] > 0
    assert store.write_csv_copy(cars(feed, ("2020-01-15", "A", "1")), root, "rail_carloadings")
    assert not store.write_csv_copy(cars(feed, ("x", "A", "1")), root, "waybill_shipments")


def carriers(spark, rows, stamp="2024-05-01"):
    """Carriers: (number, state, drivers, mileage year) as the table's rows."""
    full = [("fmcsa", date(y, 12, 31), n, "A", st, 1, d, 10, y, datetime.fromisoformat(stamp)) for n, st, d, y in rows]
    return spark.createDataFrame(full, table("motor_carrier_census").schema)


def test_a_merge_shuffles_only_what_may_collide(spark, tmp_path):
    root, name = str(tmp_path), "motor_carrier_census"
    old = [(str(i), "TX", i, 2020 + i % 2) for i in range(400)]
    assert store.merge_partitions(spark, carriers(spark, old + old[:5]), root, name) == 405
    assert store_scan.scan_table(spark, root, name).count() == 405  # a first write keeps copies
    again = [*old[:3], ("new", "TX", 1, 2020)]
    assert store.merge_partitions(spark, carriers(spark, again, "2024-05-02"), root, name) == 4
    rows = store_scan.scan_table(spark, root, name)
    assert rows.where("year(snapshot_date) = 2020").count() == 201  # copies are gone where it was merged
    assert rows.count() == 401
    assert rows.where("ingested_at = TIMESTAMP '2024-05-02'").count() == 4
    marked = store_scan.table_path(root, name) + "/p_year=2020/_merged"
    assert path_exists(spark, marked)
    # Now 2020 is known to hold no copies: only rows with a digest of the batch are shuffled.
    assert store.merge_partitions(spark, carriers(spark, [("0", "TX", 0, 2020), ("x", None, None, 2020)], "2024-05-03"), root, name) == 2
    rows = store_scan.scan_table(spark, root, name)
    assert rows.count() == 402 and rows.where("ingested_at = TIMESTAMP '2024-05-03'").count() == 2
    assert rows.dropDuplicates([c for c in rows.columns if c != "ingested_at"]).where("year(snapshot_date) = 2020").count() == 202
    assert path_exists(spark, marked)


def test_publishing_can_be_repeated(spark, tmp_path, monkeypatch):
    root, name, stage = str(tmp_path / "store"), "motor_carrier_census", str(tmp_path / "stage")
    store.merge_partitions(spark, carriers(spark, [("a", "TX", 1, y) for y in (2019, 2020, 2021)]), root, name)
    batch = carriers(spark, [("b", "TX", 1, y) for y in (2019, 2020, 2021, 2022)])
    assert store.stage_merge(spark, batch, root, name, stage) == 4
    move, calls = store.replace_folder, []

    def breaks(spark, source, target):
        calls.append(source)
        if len(calls) == 3:
            raise OSError("lost the store")
        move(spark, source, target)

    monkeypatch.setattr(store, "replace_folder", breaks)
    with pytest.raises(OSError):
        store.publish_merge(spark, root, name, stage)
    # Staged once, the batch is not computed again.
    assert store.stage_merge(spark, batch.where("raise_error('evaluated') IS NULL"), root, name, stage) == 4
    store.publish_merge(spark, root, name, stage)
    store.publish_merge(spark, root, name, stage)
    rows = store_scan.scan_table(spark, root, name)
    assert rows.count() == 7 and rows.where("dot_number = 'b'").count() == 4
    # To a store that folders can't be moved to, rows are written once more.
    monkeypatch.setattr(store, "same_store", lambda *_: False)
    store.merge_partitions(spark, carriers(spark, [("c", "TX", 1, 2019)]), root, name)
    assert store_scan.scan_table(spark, root, name).count() == 8


def test_a_replayed_batch_is_published_again(spark, tmp_path, monkeypatch):
    root, landing, check = (str(tmp_path / x) for x in ("store", "landing", "check"))
    name = "motor_carrier_census"
    twice = [("a", "TX", 1, 2020)] * 2
    carriers(spark, twice).write.parquet(landing)

    def load() -> int:
        return incremental_ingest(spark, landing, carriers(spark, []).schema, lambda b: b, root, name, check)

    publish = ingest.publish_merge

    def breaks(*args):
        publish(*args)
        raise RuntimeError("the driver is gone before the stream commits")

    monkeypatch.setattr(ingest, "publish_merge", breaks)
    with pytest.raises(Exception, match="the driver is gone"):
        load()
    monkeypatch.setattr(ingest, "publish_merge", publish)
    assert load() == 2
    # A merge of the batch with itself would have left one of the two.
    assert store_scan.scan_table(spark, root, name).count() == 2
    assert load() == 0
    carriers(spark, [("b", "TX", 1, 2020)]).write.mode("append").parquet(landing)
    assert load() == 1
    assert store_scan.scan_table(spark, root, name).count() == 2


def test_routed_rows_are_evaluated_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows = [("rail_carloadings", 1), ("ocean_freight_rates", 2), ("unheard_of", 3), ("rail_carloadings", 4), (None, 5)]
    df = spark.createDataFrame(rows, "record_type string, n int").mapInArrow(counted, "record_type string, n int")
    routed = store.route_records(df)
    assert set(routed) == set(TABLES)
    assert sorted(r["n"] for r in routed["rail_carloadings"].collect()) == [1, 4]
    assert [r["n"] for r in routed["ocean_freight_rates"].collect()] == [2]
    assert routed["rail_tariff_rates"].columns == ["n"] and routed["rail_tariff_rates"].count() == 0
    assert calls.value == len(rows)


def test_rejects_are_kept_with_their_reasons(spark, tmp_path):
    root = str(tmp_path)
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    frame = carriers(spark, [("a", "TX", 1, 2020), ("b", "TX", -1, 2020), ("c", None, -5, 2021)])
    frame = frame.mapInArrow(counted, frame.schema)
    result = jobs.run_ingest(spark, {"census": lambda _s, _d: jobs.Fetched({"motor_carrier_census": frame})}, root)
    assert result["success"] and result["total_records_written"] == 1 and calls.value == 3
    kept = store.scan_rejects(spark, root).orderBy("record").collect()
    assert {r["run_id"] for r in kept} == {result["run_id"]}
    assert [(r["table"], r["reasons"], json.loads(r["record"])["dot_number"]) for r in kept] == [
        ("motor_carrier_census", ["driver_count must be >= 0"], n) for n in "bc"
    ]
    assert store.scan_rejects(spark, str(tmp_path / "none")).count() == 0


def test_ledger_of_unreadable_files(spark, tmp_path):
    root, name = str(tmp_path), "motor_carrier_census"
    store.merge_partitions(spark, carriers(spark, [(str(i), "TX", 1, 2020 + i % 3) for i in range(30)]), root, name)
    path = store_scan.table_path(root, name)
    good = next(Path(path, "p_year=2021").glob("*.parquet")).read_bytes()
    for bad, content in {"a": b"P", "b": b"PAR1 and no more", "c": good[:-200] + good[-8:], "d": good[40:]}.items():
        Path(path, "p_year=2021", f"{bad}.parquet").write_bytes(content)
    rows, ledger = store_scan.scan_with_ledger(spark, root, name)
    assert rows.count() == 30
    lost = ledger.collect()
    assert sorted(r["path"].rpartition("/")[2][0] for r in lost) == list("abcd") and all(r["reason"] for r in lost)
    Path(root, "pipeline_runs").mkdir()
    Path(root, "pipeline_runs", "x.json").write_text("{")
    every = {(r["table"], r["path"].rpartition("/")[2]) for r in store_scan.unreadable_files(spark, root).collect()}
    assert every == {(name, f"{c}.parquet") for c in "abcd"} | {("pipeline_runs", "x.json")}
    rows, ledger = store_scan.scan_with_ledger(spark, root, "rail_carloadings")
    assert rows.count() == ledger.count() == 0


def test_describe_brackets_that_miss_fall_back(spark, monkeypatch):
    rng = random.Random(3)
    values = [rng.choice([0.0, 1.0, rng.gauss(0, 1e6), float("inf"), float("-inf")]) for _ in range(5000)]
    df = spark.createDataFrame([(v, 7) for v in values] + [(float("nan"), None)], "v double, w int")
    # Without slack the sketch's errors leave some ranks outside.
    for slack, size in ((0.005, 2048), (0.0, 8)):
        monkeypatch.setattr(profile, "_SLACK", slack)
        monkeypatch.setattr(profile, "_SKETCH", size)
        row = {r["column"]: r for r in profile.describe_numeric(df).collect()}
        ranked = sorted(values)
        want = []
        for p in (0.25, 0.5, 0.75):
            low, high = (ranked[f((len(ranked) - 1) * p)] for f in (math.floor, math.ceil))
            want.append(low if low == high else low + (high - low) * ((len(ranked) - 1) * p % 1))
        assert [row["v"][q] for q in ("q25", "q50", "q75")] == pytest.approx(want)
        assert row["w"]["q50"] == 7 and row["v"]["count"] == 5000


def test_brackets_give_one_entry_for_a_row_and_column(spark):
    names = [f"c{i}" for i in range(8)]
    df = spark.range(40).select(*[(F.col("id") + i).cast("double").alias(c) for i, c in enumerate(names)])
    spans = [(c, float(10 * j), float(10 * j + 2), 0, [0]) for c in names for j in (1, 2, 3)]
    held = profile._held(df, {c: F.col(c) for c in names}, spans)
    want = {}
    for i, (c, low, high, _, _) in enumerate(spans):
        for v in (float(k + names.index(c)) for k in range(40)):
            if v < low or v <= high:
                key = (i, v < low, None if v < low else v)
                want[key] = want.get(key, 0) + 1
    sums = {}
    for r in held.collect():
        sums[r["span"], r["below"], r["v"]] = sums.get((r["span"], r["below"], r["v"]), 0) + r["n"]
    assert sums == want
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and plan.count("inline(") == 1 and plan.index("inline(") < plan.index("Aggregate")


def test_sources_run_side_by_side(spark, tmp_path):
    spans = {}

    def slow(name, year):
        def fetch(_spark, _day):
            began = time.monotonic()
            carriers(spark, []).mapInArrow(lambda b: (time.sleep(1.5), b)[1], "source string").count()
            rows = carriers(spark, [(name, "TX", 1, year)])
            spans[name] = (began, time.monotonic())
            return jobs.Fetched({"motor_carrier_census": rows})

        return fetch

    def broken(_spark, _day):
        raise RuntimeError("feed is down")

    def endless(_spark, _day):
        def wait(batches):
            time.sleep(120)
            yield from batches

        Timer(4, jobs.cancel_source, (spark, "run_q", "endless")).start()
        carriers(spark, [("z", "TX", 1, 2020)]).mapInArrow(wait, "source string").count()

    registry = {"a": slow("a", 2020), "broken": broken, "b": slow("b", 2020), "endless": endless}
    jobs.log.disabled = True
    began = time.monotonic()
    run = jobs.run_ingest(spark, registry, str(tmp_path), run_id="run_q")
    assert time.monotonic() - began < 90
    assert run["sources_succeeded"] == ["a", "b"] and run["sources_failed"] == ["broken", "endless"]
    assert run["errors"][0] == "broken: feed is down" and "cancel" in run["errors"][1].lower()
    assert spans["a"][0] < spans["b"][1] and spans["b"][0] < spans["a"][1]
    assert run["total_records_written"] == 2  # both into one partition, one after the other
    assert store_scan.scan_table(spark, str(tmp_path), "motor_carrier_census").count() == 2


def test_profile_of_a_grown_store_reads_only_what_changed(spark, tmp_path):
    root, name = str(tmp_path), "motor_carrier_census"
    rows = [(str(i), "TX" if i % 3 else None, i, 2018 + i % 4) for i in range(4000)]
    store.merge_partitions(spark, carriers(spark, rows), root, name)
    assert profiles.refresh_facts(spark, root, name) == 4 and profiles.refresh_facts(spark, root, name) == 0
    store.merge_partitions(spark, carriers(spark, [(f"n{i}", "OK", 1, 2021) for i in range(500)] + [("x", "NM", 1, 2030)]), root, name)
    assert profiles.refresh_facts(spark, root, name) == 2
    got = {r["column"]: r for r in profiles.profile_stored(spark, root, name).collect()}
    want = {r["column"]: r for r in profile.profile_columns(store_scan.scan_table(spark, root, name)).collect()}
    assert set(got) == set(want)
    for c, r in want.items():
        assert (got[c]["dtype"], got[c]["non_null"], got[c]["null_pct"]) == (r["dtype"], r["non_null"], r["null_pct"])
        assert (got[c]["unique"] is None) == (r["unique"] is None)
        assert r["unique"] is None or abs(got[c]["unique"] - r["unique"]) <= 0.03 * r["unique"]
    assert want["dot_number"]["unique"] == 4501 and got["state"]["unique"] == 3
    assert profiles.profile_stored(spark, str(tmp_path / "none"), name).count() == 0


def test_csv_copy_is_packed(spark, feed, tmp_path):
    rows = cars(feed, ("2020-01-15", "A,B", "1"), ("2020-01-16", 'x"y', "2"))
    assert store.write_csv_copy(rows, str(tmp_path), "rail_carloadings")
    copy = spark.read.option("header", "true").csv(store.csv_path(str(tmp_path), "rail_carloadings"))
    assert all(f.endswith(".csv.gz") for f in copy.inputFiles())
    assert {(r["railroad"], r["carloads"]) for r in copy.collect()} == {("A,B", "1.0"), ('x"y', "2.0")}


def test_checked_and_routed_rows_are_staged_as_they_come(spark, feed):
    good = cars(feed, ("2020-01-15", "A", "1"))
    bad = good.withColumn("carloads", F.lit(-1.0))
    valid, rejects = quality.quarantine(good.unionByName(bad), "rail_carloadings")
    assert (valid.count(), rejects.count()) == (1, 1)
    assert valid.columns == good.columns and rejects.first()["reject_reasons"]
    routed = store.route_records(good.withColumn("record_type", F.lit("rail_carloadings")))
    assert routed["rail_carloadings"].collect()[0]["railroad"] == "A"
    assert routed["rail_carloadings"].columns == good.columns
    assert routed["ocean_freight_rates"].count() == 0
    for staged in (valid, routed["rail_carloadings"]):
        files = staged.inputFiles()
        assert files and not any("_rejected=" in f or "record_type=" in f for f in files)
        assert all(".zstd." in f for f in files)


def test_rows_are_dealt_before_they_are_combined(spark):
    rows = [(1, None, 5), (1, None, 7), (2, "x", 1), (2, "x", 1), (2, "y", 1)] * 30
    df = spark.createDataFrame(rows, "k int, s string, ingested_at int").repartition(3)
    latest = dedup.dedup_keep_latest(df)
    assert sorted(map(tuple, latest.collect()), key=str) == [(1, None, 7), (2, "x", 1), (2, "y", 1)]
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")
