"""Freshness (fixture 8), run-log reports (fixture 12), gaps, coverage,
schema checks and the validation gate."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.operators import quality

ASOF = dt.datetime(2026, 6, 19, 12, 0, 0)
THRESHOLDS = {"readings": 3600.0, "generation": 86400.0, "rates": 604800.0}


def one_row(spark, ts, col="timestamp", typ="timestamp_ntz"):
    return spark.createDataFrame([(ts, 1.0)], f"{col} {typ}, total double")


@pytest.mark.parametrize(
    "source,age,fresh",
    [
        ("readings", dt.timedelta(minutes=30), True),
        ("readings", dt.timedelta(hours=2), False),
        ("readings", dt.timedelta(hours=1), False),
        ("generation", dt.timedelta(hours=12), True),
        ("generation", dt.timedelta(days=2), False),
        ("generation", dt.timedelta(days=1), False),
        ("rates", dt.timedelta(days=3), True),
        ("rates", dt.timedelta(days=10), False),
        ("rates", dt.timedelta(days=7), False),
    ],
)
def test_freshness_thresholds(spark, source, age, fresh):
    df = one_row(spark, ASOF - age)
    out = quality.freshness({source: (df, "timestamp", THRESHOLDS[source])}, ASOF).collect()[0]
    assert out.is_fresh is fresh


def test_freshness_edge_cases(spark):
    empty = spark.createDataFrame([], "timestamp timestamp_ntz, total double")
    nulls = spark.createDataFrame([(None, 1.0)], "timestamp timestamp_ntz, total double")
    ok = one_row(spark, ASOF - dt.timedelta(minutes=1))
    out = {
        r.source: r.is_fresh
        for r in quality.freshness(
            {
                "empty": (empty, "timestamp", 3600.0),
                "nulls": (nulls, "timestamp", 3600.0),
                "missing": (None, "timestamp", 3600.0),
                "ok": (ok, "timestamp", 3600.0),
                "future": (one_row(spark, ASOF + dt.timedelta(hours=5)), "timestamp", 3600.0),
            },
            ASOF,
        ).collect()
    }
    assert out == {"empty": False, "nulls": False, "missing": False, "ok": True, "future": True}


def test_repeat_failures(spark):
    now = dt.datetime(2026, 6, 19, 12)
    rows = [
        ("a", now - dt.timedelta(hours=h), "failed") for h in (1, 20, 40)
    ] + [("b", now - dt.timedelta(hours=h), "failed") for h in (1, 2)] + [
        ("c", now - dt.timedelta(days=d), "failed") for d in (4, 5, 6)
    ] + [("c", now, "success")]
    runs = spark.createDataFrame(rows, "source string, timestamp timestamp_ntz, status string")
    out = [tuple(r) for r in quality.repeat_failures(runs, asof=now).collect()]
    assert out == [("a", 3)]
    h = {r.source: r for r in quality.health_summary(runs).collect()}
    assert h["c"].success_rate == 25.0 and h["c"].last_success == now and h["a"].last_success is None


def brute_gaps(ts_list, threshold):
    s = sorted(set(t for t in ts_list if t is not None))
    return [(a, b) for a, b in zip(s, s[1:]) if (b - a).total_seconds() > threshold]


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 16])
def test_gaps_equal_brute_force(spark, block):
    rnd = random.Random(block)
    base = dt.datetime(2024, 1, 1)
    ts = [base + dt.timedelta(minutes=rnd.choice([1, 5, 30, 90]) * i) for i in range(300)]
    ts += ts[:20] + [None]  # duplicates and a NULL
    df = spark.createDataFrame([(t, "k%d" % (i % 3)) for i, t in enumerate(ts)], "ts timestamp_ntz, key string")
    got = sorted((r.gap_start, r.gap_end) for r in quality.gaps(df, "ts", 3600, block=block).collect())
    assert got == brute_gaps(ts, 3600)
    by = sorted((r.key, r.gap_start, r.gap_end) for r in quality.gaps(df, "ts", 3600, by=["key"], block=block).collect())
    exp = sorted(
        (k, a, b) for k in ("k0", "k1", "k2")
        for a, b in brute_gaps([t for i, t in enumerate(ts) if "k%d" % (i % 3) == k], 3600)
    )
    assert by == exp


def test_missing_buckets_and_coverage(spark):
    base = dt.datetime(2024, 1, 1)
    hours = [h for h in range(60) if h not in (5, 6, 30)]
    df = spark.createDataFrame([(base + dt.timedelta(hours=h, minutes=7),) for h in hours], "ts timestamp_ntz")
    miss = sorted(r.bucket for r in quality.missing_buckets(df, "ts", 3600).collect())
    assert miss == [base + dt.timedelta(hours=h) for h in (5, 6, 30)]
    cov = quality.coverage(df, "ts", 3600, 0.95).collect()[0]
    assert (cov.buckets_found, cov.buckets_expected, cov.complete) == (57, 60, True)
    assert quality.coverage(df, "ts", 3600, 0.99).collect()[0].complete is False


def test_not_null_unique_range_and_gate(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (2, 40000.0), (None, 1.0)], "k int, total double")
    nn = {r.column_name: r.null_count for r in quality.check_not_null(df, ["k", "total"]).collect()}
    assert nn == {"k": 1, "total": 1}
    assert [tuple(r) for r in quality.check_unique(df, ["k"]).collect()] == [(1, 2)]
    rv = quality.range_violations(df, {"total": (0, 30000)}).collect()[0]
    assert rv.violations == 1 and rv.severity == "error"
    ns = {r.column_name: r.severity for r in quality.null_share(df, ["k"], 5.0).collect()}
    assert ns == {"k": "error"}
    rep = quality.validation_report(
        rv and quality.range_violations(df, {"total": (0, 30000)}).select(
            F.lit("range").alias("check_name"), "severity")
    )
    assert quality.gate_exit_code(rep) == 2


def test_row_count_regression(spark):
    counts = spark.createDataFrame([("t", 1, 100), ("t", 2, 95), ("t", 3, 80)], "tbl string, run int, n long")
    sev = [r.severity for r in quality.row_count_regression(counts, ["tbl"], "run", "n").orderBy("run").collect()]
    assert sev == ["ok", "ok", "error"]


def test_schema_drift_and_freeze(spark):
    exp = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    act = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    rows = {(r.column_name, r.change) for r in quality.schema_drift(exp, act, spark).collect()}
    assert rows == {("a", "retyped"), ("b", "removed"), ("c", "added")}
    df = spark.createDataFrame([(1, "x")], "a int, c string")
    with pytest.raises(quality.SchemaViolation):
        quality.enforce_schema(df, exp, "freeze")
    by_name = quality.enforce_schema(df, exp, "by_name").collect()[0]
    assert (by_name.a, by_name.b) == (1, None)


def test_backfill_ranges(spark):
    base = dt.datetime(2024, 1, 1)
    hours = [h for h in range(48) if h not in (5, 6, 7, 30, 40, 41)]
    df = spark.createDataFrame([(base + dt.timedelta(hours=h),) for h in hours], "ts timestamp_ntz")
    ranges = sorted(tuple(r) for r in quality.backfill_ranges(quality.missing_buckets(df, "ts", 3600)).collect())
    H = lambda h: base + dt.timedelta(hours=h)
    assert ranges == [(H(5), H(7), 3), (H(30), H(30), 1), (H(40), H(41), 2)]


def test_missing_buckets_and_ranges_match_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 2, 27)  # crosses a month end and a leap day
    for _ in range(3):
        present = sorted(rnd.sample(range(120), 70))
        df = spark.createDataFrame([(base + dt.timedelta(hours=h, minutes=rnd.randint(0, 59)),) for h in present], "ts timestamp_ntz")
        lo, hi = present[0], present[-1]
        miss = [h for h in range(lo, hi + 1) if h not in set(present)]
        got = sorted(r.bucket for r in quality.missing_buckets(df, "ts", 3600).collect())
        assert got == [base + dt.timedelta(hours=h) for h in miss]
        runs, start = [], None
        for i, h in enumerate(miss):
            if start is None:
                start = h
            if i + 1 == len(miss) or miss[i + 1] != h + 1:
                runs.append((base + dt.timedelta(hours=start), base + dt.timedelta(hours=h), h - start + 1))
                start = None
        ranges = sorted(tuple(r) for r in quality.backfill_ranges(quality.missing_buckets(df, "ts", 3600)).collect())
        assert ranges == runs


@pytest.mark.parametrize("threshold", [0, 0.000001, 0.5, 59, 60, 61, 3600, 86400])
def test_gaps_at_cell_and_block_edges(spark, threshold):
    base = dt.datetime(1969, 12, 31, 22)  # on both sides of the epoch
    ts = [base + dt.timedelta(seconds=60 * i) for i in range(4)] + [base + dt.timedelta(seconds=3600 * i) for i in range(1, 6)]
    ts += [base + dt.timedelta(microseconds=k) for k in (0, 1, 2, 500_000, 1_000_001)] + [base + dt.timedelta(days=3)]
    df = spark.createDataFrame([(t,) for t in ts * 2], "ts timestamp_ntz").repartition(3)
    for block in (1, 2, 1 << 16):
        got = sorted((r.gap_start, r.gap_end) for r in quality.gaps(df, "ts", threshold, block=block).collect())
        assert got == brute_gaps(ts, threshold)


def test_gaps_of_dates_and_of_nothing(spark):
    days = [dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 3, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [(r.gap_start, r.gap_end, r.gap_seconds) for r in quality.gaps(df, "d", 86400).collect()]
    assert got == [(days[1], days[2], 2 * 86400.0)]
    assert quality.gaps(df.limit(0), "d", 86400).collect() == []
    assert quality.backfill_ranges(df.limit(0), "d", 86400).collect() == []


@pytest.mark.parametrize("block", [1, 2, 5, 1 << 16])
def test_ranges_at_block_edges(spark, block):
    rnd = random.Random(block)
    base = dt.datetime(1969, 12, 30)
    rows = [(k, base + dt.timedelta(hours=h)) for k in ("a", "b", None) for h in rnd.sample(range(90), 60)]
    rows += [("a", base + dt.timedelta(hours=h, minutes=30)) for h in (1, 2, 3, 50)]  # off the raster: runs of their own
    rows += rows[:5] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, bucket timestamp_ntz").repartition(3)
    want = []
    for k in ("a", "b", None):
        for phase in (0, 30):
            hours = sorted({t for x, t in rows if x == k and t is not None and t.minute == phase})
            start = None
            for i, t in enumerate(hours):
                start = start or t
                if i + 1 == len(hours) or hours[i + 1] - t != dt.timedelta(hours=1):
                    want.append((k, start, t, int((t - start).total_seconds() // 3600) + 1))
                    start = None
    key = lambda r: (r[0] or "", r[1])
    got = sorted((tuple(r) for r in quality.backfill_ranges(df, by=["k"], block=block).collect()), key=key)
    assert got == sorted(want, key=key)
