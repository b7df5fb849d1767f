import tracemalloc
import zipfile
from collections import defaultdict
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from railyard.constants import BORDER_VIEWS
from workload import QUERIES, selection
from workload.raw import BORDER, INCIDENTS
from workload.registry import raw


@pytest.fixture
def orders(spark, tmp_path):
    """A folder with a table of orders: nulls, copies and text that JSON must escape."""
    rows = [(i, i % 50, 'O"[]{},\\' if i % 3 else None, i * 1.5, datetime(1996, 1 + i % 12, 1 + i % 28), "1-\nURGENT") for i in range(1, 2000)]
    rows += [(None, None, None, None, None, None)] * 2 + rows[:20]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_pages_are_written_object_by_object(spark, orders, monkeypatch):
    written = []
    text = DataFrameWriter.text

    def watched(self, path, *args, **kwargs):
        written.append((path, self._df.agg(F.max(F.length("value"))).first()[0]))
        return text(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "text", watched)
    rows = QUERIES["scan_json_pages"](spark, orders)
    want = raw(spark, orders, INCIDENTS)
    assert rows.count() == want.count() == 2021
    assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
    # A value is an object at most, whatever a page holds, and a page is a whole array.
    (path, longest), = written
    assert longest < 2000
    files = spark.read.text(path, wholetext=True).where("value <> ''")
    as_array = F.size(F.from_json("value", "array<struct<year:string,narrative:string>>"))
    sizes = [r[0] for r in files.select(as_array).collect()]
    assert len(sizes) == 64 and sum(sizes) == 2021


def test_pages_of_an_empty_table(spark, orders, tmp_path):
    spark.read.parquet(f"{orders}/orders.parquet").limit(0).write.parquet(f"{tmp_path}/none/orders.parquet")
    assert QUERIES["scan_json_pages"](spark, f"{tmp_path}/none").isEmpty()


@pytest.fixture
def lineitem(spark, tmp_path):
    """A folder with a table of lines: six years, nulls and copies."""
    rows = [(i, i % 90, i % 70, 1 + i % 7, 5.0 + i % 9, i * 1.25, 0.05, "ANR"[i % 3], datetime(1996 + i // 36 % 6, 1 + i // 3 % 12, 1 + i % 28)) for i in range(1, 3000)]
    rows += [(None,) * 9] * 2 + [(i, 1, 1, 1, 1.0, 1.0, 0.0, "A", None) for i in (3, 53)] + rows[:30]
    schema = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, l_quantity double,"
        " l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp"
    )
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1).write.parquet(f"{tmp_path}/part.parquet")  # a column's name holds the table's
    return str(tmp_path)


def test_border_archives_hold_every_line(spark, lineitem, tmp_path):
    frame = selection.border_archives(spark, lineitem, f"{tmp_path}/zips")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    paths = [r["archive"] for r in frame.collect()]
    got, damaged = defaultdict(list), set()
    for path in paths:
        with zipfile.ZipFile(path) as z:
            for info in z.infolist():
                name = f"{path.rpartition('/')[2]}/{info.filename}"
                try:
                    header, *lines = z.read(info).decode().split("\n")
                except Exception:
                    damaged.add(name)
                    continue
                assert header == BORDER_VIEWS[info.filename[5:9]]
                got[name] = sorted(lines)
    want = defaultdict(list)
    for r in raw(spark, lineitem, BORDER).collect():
        if r["source_file"] and r["YEAR"]:
            view, y, m = r["source_file"], r["YEAR"], "01" if r["MONTH"] == "13" else r["MONTH"]
            line = ",".join(r[c] or "" for c in BORDER_VIEWS[view].split(","))
            for i in range(2 if m == "03" else 1):
                want[f"{y}-{m}-{i}.zip/{y}/{view}_{m}{y[2:]}.csv"].append(line)
            if view == "dot1" and m in ("05", "06"):
                want[f"{y}-06-0.zip/{y}/dot1_ytd_06{y[2:]}.csv"].append(line)
    assert damaged == {f"{y}-05-0.zip/{y}/dot1_05{y[2:]}.csv" for y in ("2000", "2001")}
    assert got == {k: sorted(v) for k, v in want.items() if k not in damaged}


def test_a_months_archive_is_written_as_its_lines_come(tmp_path):
    def batches(n):
        for i in range(n):
            rows = [("2001", "03", "dot1_0301.csv", f"{i},{j}" + "x" * 90) for j in range(1000)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["y", "m", "member", "line"])

    peaks = []
    for n in (20, 400):
        tracemalloc.start()
        (packed,) = selection.pack_months(batches(n), f"{tmp_path}/{n}")
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        one, two = packed.column(0).to_pylist()
        with zipfile.ZipFile(one) as z, open(one, "rb") as a, open(two, "rb") as b:
            assert len(z.read("2001/dot1_0301.csv").split(b"\n")) == 1 + 1000 * n
            assert a.read() == b.read()
    # Twenty times the lines, forty megabytes, in the same memory.
    assert peaks[1] < peaks[0] + 500_000
