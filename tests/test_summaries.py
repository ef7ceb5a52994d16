"""Mergeable summaries, stored maxima, and tables stored by the hour."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ampere.operators import quality, summaries
from ampere.plans import stored_layout
from ampere.plans.load import is_fresh
from ampere.plans.marts import fct_generation, fct_intensity
from ampere.schemas import GENERATION_RAW, GENERATION_SPEC, READING_MEASURES, READINGS_RAW
from ampere.plans import staging
from ampere.sinks import key_index
from ampere.sinks.tables import upsert_table
from ampere.sources.readings_page import readings_from_pages
from spoil import restore, spoil

KIND = "ts timestamp_ntz, a double, b int"
SPEC = summaries.Spec(("a", "b"), {"a": (0.0, 50.0), "b": (-5, 900)}, "ts")


def rows(seed, month, n=400):
    r = random.Random(seed)
    base = dt.datetime(2024, month, 1)
    return [(base + dt.timedelta(minutes=r.randrange(60 * 24 * 20)), r.choice([None, r.gauss(20, 15), 7.0]), r.randrange(1000)) for _ in range(n)]


def save(spark, path, data, mode="append"):
    df = spark.createDataFrame(data, KIND).withColumn("month", F.date_format("ts", "yyyy-MM"))
    df.write.mode(mode).partitionBy("month").parquet(path)


def as_rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_merged_equals_direct(spark, scratch):
    table, store = f"{scratch}/t", f"{scratch}/s"
    save(spark, table, [x for m in (1, 2, 3) for x in rows(m, m)])
    assert [p for (p,) in summaries.refresh(spark, table, store, SPEC, ["month"])] == ["2024-01", "2024-02", "2024-03"]
    save(spark, table, rows(9, 4) + rows(10, 2, 50))  # a new month, and more of an old one
    old = spoil(table, ["month=2024-02/", "month=2024-04/"])
    assert [p for (p,) in summaries.refresh(spark, table, store, SPEC, ["month"])] == ["2024-02", "2024-04"]
    restore(old)
    df = spark.read.parquet(table)
    merged = summaries.merge(summaries.stored(spark, table, store, ["month"]))
    assert as_rows(summaries.null_share(merged)) == as_rows(quality.null_share(df, ["a", "b"]))
    assert as_rows(summaries.range_violations(merged, SPEC)) == as_rows(quality.range_violations(df, SPEC.bounds))
    assert as_rows(summaries.coverage(merged, SPEC)) == as_rows(quality.coverage(df, "ts"))
    direct = summaries.merge(summaries.summarise(df.withColumn("all", F.lit(1)), SPEC, ["all"]))
    exact = [c for c in merged.columns if c not in ("distinct", "quantiles")]
    assert as_rows(merged.select(exact)) == as_rows(direct.select(exact))


def test_sketch_errors(spark):
    """Within three standard errors of the distinct count, and within the rank error of the quantiles, after 30 merges."""
    df = spark.range(30_000).select(
        (F.col("id") % 30).alias("part"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
        F.pmod(F.xxhash64("id"), F.lit(9_000)).cast("double").alias("a"), F.col("id").cast("int").alias("b"),
    )
    merged = summaries.merge(summaries.summarise(df, SPEC, ["part"]))
    got = {r.column_name: r for r in summaries.distinct_and_quantiles(merged).collect()}
    true = df.select(F.count_distinct("a"), F.count_distinct("b")).first()
    for c, n in zip("ab", true):
        assert abs(got[c].distinct_values - n) <= 3 * 0.016 * n
    for q, cut in ((0.05, got["b"].q05), (0.5, got["b"].q50), (0.95, got["b"].q95)):
        assert abs(cut / 30_000 - q) <= 0.017


def test_run_log_summaries(spark):
    now = dt.datetime(2024, 5, 1)
    log = [("a", now - dt.timedelta(days=d), s, d % 3) for d, s in enumerate(["success", "failed", "failed", "success", "partial"])] + [("b", now, "failed", 0)]
    runs = spark.createDataFrame(log, "source string, timestamp timestamp_ntz, status string, part int")
    merged = summaries.merge_runs(summaries.run_summary(runs, ["part"]))
    assert as_rows(merged) == as_rows(quality.health_summary(runs))


def test_newest_row_without_reading_data(spark, scratch):
    path = f"{scratch}/gen"
    at = lambda m, h: dt.datetime(2024, m, 3, h)
    rows = [(at(m, h), *[1.0] * 8) for m in (1, 2, 3) for h in (1, 5)]
    gen = spark.createDataFrame(rows, GENERATION_RAW).withColumn("month", F.date_format("timestamp", "yyyy-MM"))
    upsert_table(spark, path, gen, ["timestamp"], ["month"])
    spoil(path)
    assert key_index.greatest(spark, path, "timestamp", ["month"]) == at(3, 5)
    assert is_fresh(spark, GENERATION_SPEC, path, "generation", at(3, 23), ["month"])
    assert not is_fresh(spark, GENERATION_SPEC, path, "generation", at(3, 5) + dt.timedelta(days=1), ["month"])
    # a file without an index yet is read
    spark.createDataFrame([(at(2, 20), *[1.0] * 8), (at(4, 7), *[1.0] * 8)], GENERATION_RAW).withColumn("month", F.date_format("timestamp", "yyyy-MM")).where(
        "month = '2024-04'"
    ).write.mode("append").partitionBy("month").parquet(path)
    assert key_index.greatest(spark, path, "timestamp", ["month"]) == at(4, 7)


@pytest.fixture
def hourly(spark, scratch):
    at = lambda h, m=0: dt.datetime(2024, 3, 1) + dt.timedelta(hours=h, minutes=m)
    gen = spark.createDataFrame([(at(h), *[float(h)] * 7, 7.0 * h) for h in range(60)] + [(None, *[1.0] * 8)], GENERATION_RAW)
    rd = spark.createDataFrame([(at(h, m), *[float(h)] * 19) for h in range(40, 90) for m in (5, 35)] + [(None, *[1.0] * 19)], READINGS_RAW)
    return fct_generation(staging.stg_generation(spark, gen, None)), staging.stg_readings(spark, rd, None)


def test_join_of_tables_stored_by_the_hour(spark, scratch, hourly):
    fact, readings = hourly
    n = stored_layout.buckets_for(10)
    a = stored_layout.save_by_hour(fact, "stored_fact", f"{scratch}/fact", n)
    b = stored_layout.save_by_hour(stored_layout.readings_by_hour(readings), "stored_readings", f"{scratch}/readings", n)
    try:
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = stored_layout.fct_intensity_stored(a, b)
        p = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in p and p.count("FileScan") == 2
        want = fct_intensity(fact, readings)
        assert joined.columns == want.columns and as_text(joined) == as_text(want)
        # and the newest row per hour needs no exchange either
        from ampere.operators.keyed import dedupe_latest

        one = dedupe_latest(b, ["hour"], [F.col("ts").desc()])
        assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        kept = spark.table("stored_fact").schema.simpleString()[len("struct<") : -1].replace(":", " ")
        spark.sql("DROP TABLE stored_fact")  # the files stay
        again = stored_layout.attach_by_hour(spark, "stored_fact", f"{scratch}/fact", kept, n)
        assert again.count() == fact.count()
    finally:
        for name in ("stored_fact", "stored_readings"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def as_text(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def test_buckets_line_up():
    assert stored_layout.buckets_for(0) == 8 and stored_layout.buckets_for(100 << 40) == 1 << 19
    assert stored_layout.buckets_for(9 * (256 << 20)) == 16


PAGE = """<html><body><div id=top><div><b><span bind="timeOfReading"></span></b>Thu Oct  4, 12 PM - 1 PM</div></div>
<div class=x><b><span bind="imports"></span></b>1,234 MW</div><div><span bind='exports'>-20</span> MW</div>
<div><span bind="netImportExports"></span>N/A</div>
<div><div><p class=l>POWER GENERATED</p></div><div>17,000 <i>MW</i></div></div>
<div><p>ONTARIO DEMAND now</p></div> <div>16,500.5 MW</div><div><p>TOTAL EMISSIONS</p></div><div>900 tonnes</div>
<div><p>CO2e INTENSITY</p><br></div><div> 53 g/kWh</div>
<div><span bind="nuclearOutput"></span>9,100 MW</div><div>%<span bind="nuclearPercentage"></span></div>
<div><span bind="gasPercentage"></span>12.5%</div><div>no <span bind="windOutputs">5 MW</span></div></body></html>"""


def test_readings_page(spark):
    waiting = PAGE.replace("Thu Oct  4, 12 PM - 1 PM", "updating data...")
    df = spark.createDataFrame([(1, PAGE), (2, waiting), (3, None), (4, ""), (5, "<div>" * 3000 + "x")], "page_id long, html string")
    out = readings_from_pages(df, dt.date(2024, 11, 2), keep=["page_id"]).collect()
    assert [r.page_id for r in out] == [1]
    r = out[0].asDict()
    assert r.pop("timestamp") == dt.datetime(2024, 10, 4, 12)
    want = {"page_id": 1, "imports_mw": 1234.0, "power_generated_mw": 17000.0, "ontario_demand_mw": 16500.5, "total_emissions_tonnes": 900.0}
    want |= {"exports_mw": -20.0, "co2e_intensity_gco2_per_kwh": 53.0, "nuclear_mw": 9100.0, "gas_pct": 12.5}
    assert r == {c: want.get(c) for c in ["page_id", *READING_MEASURES]}
