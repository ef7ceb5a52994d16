"""Scalar functions (F-series) on small inline fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ampere.functions import (
    camel_to_snake,
    classify,
    clean_cell,
    clean_header,
    conditional_fill,
    hour_ending_to_start,
    iso_hour,
    pad_array,
    parse_long_date,
    parse_numeric,
    parse_reading_time,
    round_half_away,
    seasonal_split,
    share_pct,
    strip_units,
    to_utc_naive,
    zip_shortest,
)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


CLASSIFY_CASES = [
    ("PICKERING G5", "nuclear"),
    ("Darlington NGS", "nuclear"),
    ("BRUCE A", "nuclear"),
    ("AMARANTH WIND", "wind"),
    ("KINGSTON SOLAR", "solar"),
    ("SARNIA PV", "solar"),
    ("ATIKOKAN BIOMASS", "biofuel"),
    ("BECK 2", "hydro"),
    ("DES JOACHIMS", "hydro"),
    ("LENNOX G1", "gas"),
    ("MYSTERY PLANT", "other"),
    # ours: precedence — a nuclear word wins over a wind word
    ("BRUCE WIND FARM", "nuclear"),
    ("WIND SOLAR HYBRID", "wind"),
    ("PORTLANDS GU 1", "gas"),
]


def test_classify_rules(spark):
    got = one(spark, [(n,) for n, _ in CLASSIFY_CASES], "n string", classify(F.col("n")))
    assert got == [c for _, c in CLASSIFY_CASES]


READING_CASES = [
    ("Thu Oct 14, 8 AM - 9 AM", "2026-06-19", dt.datetime(2026, 10, 14, 8)),
    ("Mon Jan  5, 12 AM - 1 AM", "2026-06-19", dt.datetime(2026, 1, 5, 0)),
    ("Fri Jun 19, 12 PM - 1 PM", "2026-06-19", dt.datetime(2026, 6, 19, 12)),
    ("Sat Mar  7, 11 PM - 12 AM", "2026-06-19", dt.datetime(2026, 3, 7, 23)),
    # ours: a December label read in January belongs to the previous year
    ("Wed Dec 31, 11 PM - 12 AM", "2027-01-01", dt.datetime(2026, 12, 31, 23)),
    # a December label read in June keeps the current year (source behaviour)
    ("Wed Dec 31, 1 PM - 2 PM", "2026-06-19", dt.datetime(2026, 12, 31, 13)),
]


def test_parse_reading_time(spark):
    df = spark.createDataFrame([(r, a) for r, a, _ in READING_CASES], "raw string, asof string")
    got = [r[0] for r in df.select(parse_reading_time(F.col("raw"), F.col("asof"))).collect()]
    assert got == [e for _, _, e in READING_CASES]


def test_parse_reading_time_unparsable(spark):
    df = spark.createDataFrame([("updating data...",)], "raw string")
    assert df.select(parse_reading_time("raw", "2026-06-19")).collect()[0][0] is None
    with pytest.raises(Exception, match="unexpected reading-time label"):
        df.select(parse_reading_time("raw", "2026-06-19", strict=True)).collect()


def test_parse_numeric(spark):
    rows = [("1234.5",), ("  42.0  ",), ("",), ("N/A",), (None,), ("1d",), ("-3e2",), (".5",)]
    got = one(spark, rows, "s string", parse_numeric("s"))
    assert got == [1234.5, 42.0, None, None, None, None, -300.0, 0.5]


def test_strip_units(spark):
    rows = [("1,234 MW",), ("56.7%",), ("310 g/kWh",), ("8.7 ¢ per kWh",)]
    got = one(spark, rows, "s string", parse_numeric(strip_units("s", [" MW", "%", " g/kWh", " ¢ per kWh"])))
    assert got == [1234.0, 56.7, 310.0, 8.7]


def test_hour_ending(spark):
    rows = [("2024-05-01", 1), ("2024-05-01", 2), ("2024-05-01", 24)]
    got = one(spark, rows, "d string, h int", hour_ending_to_start("d", "h"))
    assert got == [dt.datetime(2024, 5, 1, 0), dt.datetime(2024, 5, 1, 1), dt.datetime(2024, 5, 1, 23)]
    iso = one(spark, [(g,) for g in got], "t timestamp_ntz", iso_hour("t"))
    assert iso == ["2024-05-01T00:00:00", "2024-05-01T01:00:00", "2024-05-01T23:00:00"]


def test_to_utc(spark):
    rows = [("2023-03-12 01:00:00-05:00",), ("2023-03-12 03:00:00-04:00",), ("2023-03-12 04:00:00",)]
    got = one(spark, rows, "s string", to_utc_naive("s"))
    assert got == [dt.datetime(2023, 3, 12, 6), dt.datetime(2023, 3, 12, 7), dt.datetime(2023, 3, 12, 4)]


def test_long_date(spark):
    got = one(spark, [("May 1, 2024",), ("November 15, 2023",), ("bogus",)], "s string", parse_long_date("s"))
    assert got == [dt.date(2024, 5, 1), dt.date(2023, 11, 15), None]


def test_seasonal_split_and_fill(spark):
    df = spark.createDataFrame(
        [("600 (Summer)  1,000 (Winter)", "9.3", "11.0"), ("750", "", "8.7")], "thr string, hi string, lo string"
    )
    s, w = seasonal_split("thr")
    hi, s2, w2 = conditional_fill("hi", "lo", s, w)
    got = df.select(s, w, hi, s2, w2).collect()
    assert tuple(got[0]) == ("600", "1,000", "9.3", "600", "1,000")
    assert tuple(got[1]) == ("750", "750", "8.7", "0", "0")


def test_clean_text(spark):
    rows = [("Lower tier\xa0price*",), ("Higher\n tier   price (¢ per kWh)",)]
    got = one(spark, rows, "s string", clean_header("s"))
    assert got == ["Lower tier price", "Higher tier price (¢ per kWh)"]
    assert one(spark, [(" 1,234* ",)], "s string", clean_cell("s")) == ["1234"]


def test_camel_to_snake(spark):
    got = one(spark, [("netImportExports",), ("imports",)], "s string", camel_to_snake("s"))
    assert got == ["net_import_exports", "imports"]


def test_pad_and_zip(spark):
    df = spark.createDataFrame([(["a", "b"], ["x", "y", "z"])], "a array<string>, b array<string>")
    assert df.select(pad_array("a", 4)).collect()[0][0] == ["a", "b", "", ""]
    z = df.select(zip_shortest("a", "b")).collect()[0][0]
    assert [tuple(x) for x in z] == [("a", "x"), ("b", "y")]


def test_round_and_share(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (0.0, 0.0, 0.0), (0.25, 0.0, 2.0)], "a double, b double, t double")
    got = [r[0] for r in df.select(share_pct(["a", "b"], "t", 1)).collect()]
    assert got == [100.0, None, 12.5]
    assert one(spark, [(2.5,), (-2.5,), (0.125,)], "x double", round_half_away("x", 0)) == [3.0, -3.0, 0.0]


def test_parse_reading_time_multiline_label(spark):
    df = spark.createDataFrame([("Thu Oct 14, 8 AM - 9 AM\nupdated",)], "raw string")
    assert df.select(parse_reading_time("raw", "2026-06-19")).collect()[0][0] == dt.datetime(2026, 10, 14, 8)


def test_epoch_ms_and_next_month(spark):
    from ampere.functions import epoch_ms, next_month_start

    df = spark.createDataFrame([(dt.datetime(2024, 12, 15, 0, 0, 1),)], "t timestamp_ntz")
    r = df.select(epoch_ms("t"), next_month_start("t")).collect()[0]
    assert r[0] == 1734220801000 and r[1] == dt.date(2025, 1, 1)


def test_exact_sum_is_partitioning_independent(spark):
    """Two-decimal values summed as longs of cents: the same bits whatever
    the partitioning or order (a plain double sum would differ)."""
    import random

    from pyspark.sql import functions as F

    from ampere.functions import exact_sum

    rnd = random.Random(7)
    vals = [(i % 5, rnd.randint(-10**6, 10**6) / 100) for i in range(5000)]
    df = spark.createDataFrame(vals, "g int, v double")
    results = set()
    for n in (1, 3, 7, 16):
        rows = df.repartition(n).groupBy("g").agg(exact_sum("v").alias("s")).collect()
        results.add(tuple(sorted((r.g, r.s) for r in rows)))
    assert len(results) == 1
    exact = {g: round(sum(int(round(v * 100)) for gg, v in vals if gg == g) / 100, 2) for g in range(5)}
    assert dict(next(iter(results))) == exact


def test_exact_sums_keep_small_and_odd_values(spark):
    import math

    from ampere.functions import exact_avg, exact_sum, name_key

    rows = [("a", 0.004)] * 3 + [("b", 1e17), ("b", 1.0), ("c", float("nan")), ("d", None), ("e", 1e-9), ("e", 1e-9)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
    assert got["a"] == (0.012, 0.012 / 3) and got["b"][0] == 1e17 + 1 and math.isnan(got["c"][0])
    assert got["d"][0] is None and got["e"][0] == 2e-9
    assert spark.createDataFrame([("\tPlant\u00a0",)], "n string").select(name_key("n").alias("k")).first().k == "PLANT"


def test_exact_sums_of_great_and_odd_values(spark):
    """Whole numbers where they are exact, the plain sum elsewhere; both forms agree."""
    from ampere.functions import exact_sum
    from ampere.functions.numeric import _exact_sum

    groups = {
        "cents": [0.1] * 10 + [1e9 + 0.25], "big": [1e12 + 0.5, 1.0], "tiny": [1e-7, 1e-7], "nan": [float("nan"), 1.0], "inf": [float("inf"), 1.0],
        "none": [None, None], "whole": [8e9] * 2000, "minus": [-0.25, 0.5, None],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    out = df.groupBy("g").agg(exact_sum("v").alias("a"), _exact_sum(F.col("v"), 6).alias("b"), F.sum("v").alias("s"))
    got = {r.g: r for r in out.collect()}
    for g, r in got.items():
        assert r.a == r.b or (r.a != r.a and r.b != r.b)
    assert got["cents"].a == 1000000001.25 and got["big"].a == 1e12 + 1.5 and got["tiny"].a == 2e-7 and got["none"].a is None
    assert got["nan"].a != got["nan"].a and got["inf"].a == float("inf") and got["whole"].a == 1.6e13 and got["minus"].a == 0.25


def test_clip_takes_whole_days(spark):
    from ampere.operators import reports

    at = [dt.datetime(2024, 1, d, h) for d in (4, 5, 6, 7) for h in (0, 23)]
    df = spark.createDataFrame([(t,) for t in at], "ts timestamp_ntz")
    for start, end in (
        ("2024-01-05", "2024-01-06"), (dt.date(2024, 1, 5), dt.date(2024, 1, 6)), (dt.datetime(2024, 1, 5, 9), dt.datetime(2024, 1, 6, 1)), ("2024-01-05 09:00:00", "2024-01-06T01:00"),
    ):
        assert sorted(r.ts for r in reports.clip(df, "ts", start, end).collect()) == at[2:6]
