import math
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from railyard import functions as X


def results(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def python_date(text):
    try:
        return datetime.fromisoformat(text.replace("Z", "+00:00")).date()
    except ValueError:
        return None


def test_iso_dates_follow_python(spark):
    texts = [
        "2026-07-25",
        "2026-07-25T00:00:00.000",
        "2026-07-25 10:11",
        "2026-07-25x10:11:12",
        "2026-07-25T10",
        "2026-07-25T10:11:12Z",
        "2026-07-25Z",
        "2026-07-25T10:11:12+05:30",
        "2026-07-25T25:00",
        "2026-07-25Txx",
        "2026-07-25T",
        "2026-7-5",
        "2026",
        "20260725",
        "20260725T101112",
        "2026-02-30",
        "2024-02-29",
        "0000-01-01",
        "0001-01-01",
        "soon",
        "",
    ]
    assert results(spark, texts, X.parse_iso_date) == [python_date(t) for t in texts]


def python_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def test_floats_follow_python(spark):
    texts = [
        "1500", "811.5", " 12 ", "\t7\n", "1e3", "1E-2", ".5", "5.", "+3", "-4", "1_000", "1__0",
        "_1", "1d", "1f", "2D", "0x1p3", "inf", "-Infinity", "nan", "", " ", ".", "e5", "1,000",
        "abc", "1 2", "--1",
    ]
    got, want = results(spark, texts, X.safe_float), [python_float(t) for t in texts]
    same = [g == w or (g is not None and w is not None and math.isnan(g) and math.isnan(w))
            for g, w in zip(got, want, strict=True)]
    assert all(same), [(t, g, w) for t, g, w, s in zip(texts, got, want, same, strict=True) if not s]


def test_ints_are_cut_towards_zero(spark):
    texts = ["12", "12.9", "-12.9", "1e3", "", "x", "nan", "inf", "000012", "9007199254740993"]
    want = [12, 12, -12, 1000, None, None, None, None, 12, int(float("9007199254740993"))]
    assert results(spark, texts, X.safe_int) == want


def test_decimals_round_half_even(spark):
    texts = ["0.125", "0.135", "6185", "523.845", "-2.675", "1E3", "", "none"]
    want = ["0.12", "0.14", "6185.00", "523.84", "-2.68", "1000.00"]
    got = results(spark, texts, lambda c: X.safe_decimal(c, 12, 2))
    assert got == [Decimal(w) for w in want] + [None, None]


def test_census_dates(spark):
    texts = ["21-APR-26", "01-jan-68", "01-JAN-69", "31-FEB-20", "2024-01-05", "1-Oct-99", ""]
    want = [date(2026, 4, 21), date(2068, 1, 1), date(1969, 1, 1), None, None, date(1999, 10, 1), None]
    assert results(spark, texts, X.parse_dd_mon_yy) == want


def test_waybill_century_is_the_nearer_one(spark):
    texts = ["041118", "010199", "010150", "023024", "xx0118", "0411"]
    want = [date(2018, 4, 11), date(1999, 1, 1), date(2050, 1, 1), None, None, None]
    assert results(spark, texts, lambda c: X.parse_mmddyy(c, 2024)) == want
    # A tie goes to 20yy: 2000 is as far from 1950 as from 2050.
    assert results(spark, ["010150"], lambda c: X.parse_mmddyy(c, 2000)) == [date(2050, 1, 1)]


def test_units_and_slugs(spark):
    labels = ["Average Train Speed (mph)", "Dwell ( Hours )", "Cars On Line", "x ()", "a (b) c"]
    assert results(spark, labels, X.extract_unit) == ["mph", "hours", "unknown", "unknown", "unknown"]
    assert results(spark, labels, X.slug_metric) == [
        "average_train_speed", "dwell", "cars_on_line", "x", "a"
    ]


def test_strip_takes_every_whitespace(spark):
    assert results(spark, ["  a b\t\x1c", " ", "x"], X.strip) == ["a b", "", "x"]


def test_release_month(spark):
    base = "/sites/bts.dot.gov/files/transborder-raw/{}/{}.zip"
    links = [
        base.format(2026, "January2026"),
        base.format(2024, "Jan2024"),
        base.format(2025, "December2025"),
        base.format(2007, "2007"),
        "/sites/bts.dot.gov/files/other/file.zip",
    ]
    years = results(spark, links, lambda c: X.release_month(c)[0])
    months = results(spark, links, lambda c: X.release_month(c)[1])
    assert list(zip(years, months, strict=True)) == [
        (2026, 1), (2024, 1), (2025, 12), (None, None), (None, None)
    ]


def test_small_text_rules(spark):
    assert results(spark, ["0324", "32", None], X.format_period) == ["03/24", "32", ""]
    assert results(spark, ["-6.1%", "1.8 %", "%", ""], X.parse_percent) == [-6.1, 1.8, None, None]
    assert results(spark, ["2007/January 2007/dot1_0107.csv", "Dot2.x.csv"], X.view_tag) == [
        "dot1", "Dot2.x"
    ]
    joined = lambda c: X.join_nonblank(c, F.lit("  "), F.lit("MO"), F.lit(None).cast("string"))
    assert results(spark, ["IL", " "], joined) == ["IL,MO", "MO"]
    either = lambda c: X.first_truthy(c, F.lit(""))
    assert results(spark, ["a", "", None], either) == ["a", "", ""]
