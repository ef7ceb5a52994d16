"""Load ledger, change propagation to the marts, and the streaming hourly join."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ampere.operators.joins import hourly_full_outer
from ampere.plans.incremental_marts import refresh_after, refresh_marts, touched_months
from ampere.schemas import GENERATION_RAW, READING_MEASURES, READINGS_RAW
from ampere.sinks.tables import ensure_table, read_table, upsert_table
from ampere.sources.files import table_or_empty
from ampere.sources.ledger import landed, load_generation, read_ledger
from ampere.streaming.hourly import hourly_join_stream
from spoil import restore, spoil

FUELS = ["nuclear", "gas", "total"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def month_csv(folder, year, month, days, value=100):
    lines = [f"{year}-{month:02d}-{d:02d},{h},{value + h},5,{value + h + 5}" for d in days for h in (1, 24)]
    write(f"{folder}/{year}{month:02d}.csv", "Date,Hour,Nuclear,Gas,Total\n" + "\n".join(lines) + "\n")


def state(*folders):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for x in folders for f in glob.glob(f"{x}/**/*.parquet", recursive=True)}


def test_ledger_end_to_end(spark, scratch):
    land, table, ledger, log = (f"{scratch}/{n}" for n in ("land", "gen", "ledger", "runs"))
    now = dt.datetime(2024, 4, 20)

    def load(asof, **kw):
        return load_generation(spark, land, table, ledger, FUELS, log, asof, **kw)

    assert load(now).status == "nothing"  # the folder is not there yet
    for m in (1, 2, 3):
        month_csv(land, 2024, m, (1, 2))
    first = load(now)
    assert first.status == "success" and first.rows == 12 and [os.path.basename(f) for f in first.files] == ["202401.csv", "202402.csv", "202403.csv"]
    # old files cannot even be read any more, with their state unchanged
    kept = {f: os.stat(f) for f in glob.glob(f"{land}/20240[12].csv")}
    for f, s in kept.items():
        with open(f, "wb") as out:
            out.write(b"x" * s.st_size)
        os.utime(f, ns=(s.st_atime_ns, s.st_mtime_ns))
    # a second run: the boundary month has grown, and April is new
    month_csv(land, 2024, 3, (1, 2, 3))
    month_csv(land, 2024, 4, (1,))
    second = load(now + dt.timedelta(days=1))
    assert [os.path.basename(f) for f in second.files] == ["202403.csv", "202404.csv"] and second.rows == 8
    assert spark.read.parquet(table).count() == 16
    # a third one reads the boundary month alone, and changes nothing
    third = load(now + dt.timedelta(days=2))
    assert [os.path.basename(f) for f in third.files] == ["202404.csv"]
    assert spark.read.parquet(table).count() == 16
    # a changed file is loaded again
    month_csv(land, 2024, 2, (1, 2), value=500)
    fourth = load(now + dt.timedelta(days=3))
    assert [os.path.basename(f) for f in fourth.files] == ["202402.csv", "202404.csv"]
    feb = spark.read.parquet(table).where("month = '2024-02'")
    assert sorted(r.nuclear for r in feb.collect()) == [501.0, 501.0, 524.0, 524.0]
    rows = read_ledger(spark, ledger).collect()
    assert sorted((os.path.basename(r.path), r.rows) for r in rows) == [
        ("202401.csv", 4), ("202402.csv", 4), ("202402.csv", 4), ("202403.csv", 4), ("202403.csv", 6), ("202404.csv", 2), ("202404.csv", 2), ("202404.csv", 2),
    ]
    # the gate: fresh data are not loaded
    assert load(dt.datetime(2024, 4, 2, 1)).status == "skipped"
    assert sorted(r.status for r in spark.read.parquet(log).collect()) == ["skipped", *["success"] * 5]


def test_ledger_failure_is_logged_and_loaded_again(spark, scratch):
    land, table, ledger, log = (f"{scratch}/{n}" for n in ("land", "gen", "ledger", "runs"))
    write(f"{land}/202401.csv", "Date,Hour,Nuclear,Gas,Total\nnonsense,1,2,3,4\n")
    with pytest.raises(Exception, match="no date and hour"):
        load_generation(spark, land, table, ledger, FUELS, log, dt.datetime(2024, 2, 1))
    assert [r.status for r in spark.read.parquet(log).collect()] == ["failed"] and read_ledger(spark, ledger).count() == 0
    month_csv(land, 2024, 1, (1,))
    assert load_generation(spark, land, table, ledger, FUELS, log, dt.datetime(2024, 2, 1)).rows == 2


def test_listing_is_one_scan_without_content(spark, scratch):
    for i in range(30):  # a file without a byte holds nothing to load and is not listed
        write(f"{scratch}/l/{i}.csv", "x" * i)
    df = landed(spark, f"{scratch}/l", "*.csv")
    assert sorted(r.length for r in df.collect()) == list(range(1, 30))
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def generation(spark, rows):
    df = spark.createDataFrame([(t, *[v] * 7, 7 * v) for t, v in rows], GENERATION_RAW)
    return df.withColumn("month", F.date_format("timestamp", "yyyy-MM"))


def readings(spark, rows):
    df = spark.createDataFrame([(t, *[v] * len(READING_MEASURES)) for t, v in rows], READINGS_RAW)
    return df.withColumn("month", F.date_format("timestamp", "yyyy-MM"))


def rows_of(df):
    return sorted((tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("partitioned", [True, False])
def test_marts_follow_the_batches(spark, scratch, partitioned):
    raw, out = f"{scratch}/raw", f"{scratch}/marts"
    by = ["month"] if partitioned else []
    at = lambda m, h=0: dt.datetime(2024, m, 10) + dt.timedelta(hours=h)

    def load(table, df):
        upsert_table(spark, f"{raw}/{table}", df if partitioned else df.drop("month"), ["timestamp"], by)

    load("generation_live", generation(spark, [(at(m, h), float(m + h)) for m in range(1, 7) for h in range(4)]))
    load("generation_history", generation(spark, [(at(m, h), 50.0 + m) for m in range(1, 4) for h in range(3, 6)]))
    load("readings_live", readings(spark, [(at(m, h) + dt.timedelta(minutes=20), 1.0 * h) for m in range(2, 7) for h in range(3, 8)]))
    refresh_marts(spark, raw, out)
    # a correction, a new hour, a reading in a new month
    gen = generation(spark, [(at(3, 1), 900.0), (at(3, 9), 901.0)])
    rd = readings(spark, [(at(3, 9) + dt.timedelta(minutes=1), 7.0), (at(9), 8.0)])
    load("generation_live", gen)
    load("readings_live", rd)
    assert touched_months((gen, "timestamp"), (rd, "timestamp")) == ["2024-03", "2024-09"]
    others = [m for m in (1, 2, 4, 5, 6)]
    before = {m: state(*[f"{out}/{t}/part=2024-{m:02d}" for t in ("fct_generation", "fct_intensity", "_stg_readings")]) for m in others}
    # raw rows of other months cannot be read meanwhile
    hidden = spoil(raw, ["month=2024-03/", "month=2024-09/"]) if partitioned else {}
    assert refresh_after(spark, raw, out, (gen, "timestamp"), (rd, "timestamp")) == ["2024-03", "2024-09"]
    restore(hidden)
    after = {m: state(*[f"{out}/{t}/part=2024-{m:02d}" for t in ("fct_generation", "fct_intensity", "_stg_readings")]) for m in others}
    assert before == after and all(before[m] for m in others)
    full = refresh_marts(spark, raw, f"{scratch}/full")
    for name in ("fct_generation", "fct_intensity"):
        got = spark.read.parquet(f"{out}/{name}").drop("part")
        assert rows_of(got) == rows_of(full[name]) and got.columns == full[name].columns
    assert spark.read.parquet(f"{out}/fct_intensity").where("part = '2024-09'").count() == 1


def test_a_month_without_rows_loses_its_partition(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/marts"
    both = generation(spark, [(dt.datetime(2024, 1, 1), 1.0), (dt.datetime(2024, 2, 1), 1.0)])
    both.write.partitionBy("month").parquet(f"{raw}/generation_live")
    refresh_marts(spark, raw, out)
    both.where("month = '2024-01'").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month").parquet(
        f"{raw}/generation_live"
    )
    refresh_marts(spark, raw, out, ["2024-02"])
    assert [os.path.basename(p) for p in glob.glob(f"{out}/fct_generation/part=*")] == ["part=2024-01"]
    assert spark.read.parquet(f"{out}/fct_intensity").count() == 1
    assert refresh_marts(spark, f"{scratch}/none", f"{scratch}/empty")["fct_intensity"].count() == 0


def test_empty_partitioned_table_is_typed_and_not_fresh(spark, scratch):
    from ampere.plans.load import is_fresh
    from ampere.schemas import GENERATION_SPEC

    path = f"{scratch}/t"
    ensure_table(spark, path, GENERATION_RAW, ["month"])
    assert table_or_empty(spark, path, GENERATION_RAW).schema.fieldNames() == GENERATION_RAW.fieldNames()
    assert read_table(spark, path).count() == 0
    assert is_fresh(spark, GENERATION_SPEC, path, "generation", dt.datetime(2024, 1, 1)) is False


def test_streaming_join_equals_batch(spark, scratch):
    base = dt.datetime(2024, 1, 1)
    hour = lambda h, m=0: base + dt.timedelta(hours=h, minutes=m)
    kinds = ("hour timestamp_ntz, mw double", "ts timestamp_ntz, mw double, co2 double")
    # three files a side; rows are up to three hours late, on either side
    left = [[(hour(0), 1.0), (hour(2), 3.0)], [(hour(1), 2.0), (hour(4), 5.0), (hour(4), 5.5)], [(hour(3), 4.0), (hour(6), 7.0), (None, 9.0)]]
    right = [[(hour(1, 5), 1.0, 10.0), (hour(1, 50), 2.0, 11.0)], [(hour(0, 59), 3.0, 12.0), (hour(3, 1), 4.0, 13.0)], [(hour(5, 30), 5.0, 14.0), (hour(4, 0), 6.0, 15.0), (None, 0.0, 0.0)]]
    too_late_left, too_late_right = [(hour(2), 99.0)], [(hour(0, 7), 99.0, 99.0)]
    folders = [f"{scratch}/left", f"{scratch}/right"]
    frames = []
    for folder, kind in zip(folders, kinds):
        os.makedirs(folder)
        frames.append(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder))
    joined = hourly_join_stream(*frames, right_cols=["mw", "co2"], watermark="4 hours")
    query = joined.writeStream.outputMode("append").format("memory").queryName("hourly_join").option("checkpointLocation", f"{scratch}/ckpt").start()

    def feed(l, r):
        for rows, folder, kind in ((l, folders[0], kinds[0]), (r, folders[1], kinds[1])):
            spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)
        query.processAllAvailable()

    try:
        for l, r in zip(left, right):
            feed(l, r)
        far = hour(100)
        feed([(far, 0.0)], [(far, 0.0, 0.0)])  # closes the hours before
        feed(too_late_left, too_late_right)
        feed([(far, 1.0)], [(far, 1.0, 1.0)])
    finally:
        query.stop()
    streamed = spark.table("hourly_join").where(F.col("hour") < F.lit(far.isoformat(" ")).cast("timestamp_ntz"))
    L = spark.createDataFrame([x for part in left for x in part if x[0]], kinds[0])
    R = spark.createDataFrame([x for part in right for x in part if x[0]], kinds[1])
    batch = hourly_full_outer(L, R, right_cols=["mw", "co2"])
    assert streamed.columns == batch.columns and rows_of(streamed) == rows_of(batch) and batch.count() == 9
