"""Which partitions an upsert reads and writes, and that no moved key is lost."""

import datetime as dt
import glob
import os
import random

from pyspark.sql import functions as F

from spoil import spoil

from ampere.sinks import key_index
from ampere.sinks.tables import insert_absent_table, upsert_table

KIND = "k bigint, ts timestamp_ntz, v double"


def months(n):
    return [dt.datetime(2020 + i // 12, i % 12 + 1, 1) for i in range(n)]


def with_month(df):
    return df.withColumn("month", F.date_format("ts", "yyyy-MM"))


def readings(spark, rows):
    return with_month(spark.createDataFrame(rows, KIND))


def table(spark, path):
    return {r.k: (r.month, r.v) for r in spark.read.parquet(path).collect()}


def test_a_month_among_fifty_reads_its_own(spark, scratch):
    path = f"{scratch}/t"
    rows = [(100 * i + j, m + dt.timedelta(hours=j), 1.0) for i, m in enumerate(months(50)) for j in range(20)]
    first = upsert_table(spark, path, readings(spark, rows), ["k"], ["month"])
    assert len(first.written) == 50
    m = months(50)[30]
    batch = [(3000 + j, m + dt.timedelta(hours=j), 2.0) for j in range(10)] + [(3050, m + dt.timedelta(days=3), 2.0)]
    spoil(path, ["month=2022-07/"])  # any read of another partition would fail
    done = upsert_table(spark, path, readings(spark, batch), ["k"], ["month"])
    assert done.read == [("2022-07",)] and done.written == [("2022-07",)]
    got = {r.k: r.v for r in spark.read.parquet(path).where("month = '2022-07'").collect()}
    assert got == {3000 + j: 2.0 if j < 10 else 1.0 for j in range(20)} | {3050: 2.0}


def test_moved_keys_are_replaced(spark, scratch):
    path = f"{scratch}/t"
    rnd = random.Random(2)
    keys = rnd.sample(range(10**9), 400)  # keys that say nothing about the month
    rows = [(k, rnd.choice(months(20)) + dt.timedelta(hours=rnd.randrange(600)), 1.0) for k in keys]
    upsert_table(spark, path, readings(spark, rows), ["k"], ["month"])
    want = table(spark, path)
    for step in range(3):
        batch = [(k, dt.datetime(2021, 8, 2 + step), 2.0 + step) for k in rnd.sample(keys, 15)] + [(step, dt.datetime(2021, 8, 3), 9.0)]
        done = upsert_table(spark, path, readings(spark, batch), ["k"], ["month"])
        old = {want[k][0] for k, _, _ in batch if k in want}
        assert {p for (p,) in done.written} == old | {"2021-08"} and set(done.written) <= set(done.read)
        want |= {k: ("2021-08", v) for k, _, v in batch}
        rows = spark.read.parquet(path)
        assert rows.count() == len(want) and table(spark, path) == want


def test_a_partition_that_loses_its_last_row_goes(spark, scratch):
    path = f"{scratch}/t"
    upsert_table(spark, path, readings(spark, [(1, dt.datetime(2024, 1, 5), 1.0), (2, dt.datetime(2024, 2, 5), 1.0), (3, None, 1.0)]), ["k"], ["month"])
    upsert_table(spark, path, readings(spark, [(1, dt.datetime(2024, 2, 6), 5.0), (3, dt.datetime(2024, 2, 7), 6.0)]), ["k"], ["month"])
    assert table(spark, path) == {1: ("2024-02", 5.0), 2: ("2024-02", 1.0), 3: ("2024-02", 6.0)}
    assert [os.path.basename(p) for p in glob.glob(f"{path}/month=*")] == ["month=2024-02"]
    upsert_table(spark, path, readings(spark, [(1, None, 7.0)]), ["k"], ["month"])  # and into the null partition
    assert table(spark, path) == {1: (None, 7.0), 2: ("2024-02", 1.0), 3: ("2024-02", 6.0)}


def test_files_written_by_others_are_read(spark, scratch):
    path = f"{scratch}/t"
    rows = [(i, m, 1.0) for i, m in enumerate(months(6))]
    upsert_table(spark, path, readings(spark, rows), ["k"], ["month"])
    readings(spark, [(77, dt.datetime(2020, 2, 3), 1.0)]).write.partitionBy("month").mode("append").parquet(path)
    insert_absent_table(spark, path, readings(spark, [(88, dt.datetime(2020, 4, 3), 1.0), (0, dt.datetime(2020, 4, 3), 5.0)]), ["k"], partition_by=["month"])
    done = upsert_table(spark, path, readings(spark, [(77, dt.datetime(2020, 6, 3), 2.0), (88, dt.datetime(2020, 6, 3), 2.0)]), ["k"], ["month"])
    assert {"2020-02", "2020-04", "2020-06"} <= {p for (p,) in done.read}
    got = table(spark, path)
    assert got[77] == got[88] == ("2020-06", 2.0) and got[0] == ("2020-01", 1.0) and len(got) == 8
    # and its index is up to date again
    assert key_index.refresh(spark, path, ["k"], ["month"]) == []


def test_keys_of_another_type_are_found(spark, scratch):
    path = f"{scratch}/t"
    upsert_table(spark, path, readings(spark, [(5, dt.datetime(2024, 1, 1), 1.0)]), ["k"], ["month"])
    batch = readings(spark, [(5, dt.datetime(2024, 3, 1), 2.0)]).withColumn("k", F.col("k").cast("int"))
    upsert_table(spark, path, batch, ["k"], ["month"])
    assert table(spark, path) == {5: ("2024-03", 2.0)}


def test_filter_has_no_misses_and_few_false_hits(spark, scratch):
    path = f"{scratch}/t"
    df = spark.range(60_000).select(
        (F.col("id") * 2).alias("k"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("v"),
        F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(3))).alias("month"),
    )
    df.write.partitionBy("month").parquet(path)
    assert len(key_index.refresh(spark, path, ["k"], ["month"])) == 3
    inside = df.where("id % 1000 = 0").select("k", "month")
    for r in inside.collect()[::10]:
        held = key_index.may_hold(spark, path, spark.createDataFrame([(r.k,)], "k bigint"), ["k"], ["month"])
        assert (r.month,) in held
    false = [len(key_index.may_hold(spark, path, spark.createDataFrame([(2 * i + 1,)], "k bigint"), ["k"], ["month"])) for i in range(1000, 1012)]
    assert sum(false) <= 4
    outside = spark.createDataFrame([(-5,), (10**7,), (None,)], "k bigint")
    assert key_index.may_hold(spark, path, outside, ["k"], ["month"]) == []


def test_composite_and_date_keys(spark, scratch):
    path = f"{scratch}/t"
    kind = "d date, kind string, v double, era string"
    rows = [(dt.date(2000 + i, 5, 1), k, 1.0, f"e{i // 4}") for i in range(12) for k in ("x", "y")]
    upsert_table(spark, path, spark.createDataFrame(rows, kind), ["d", "kind"], ["era"])
    done = upsert_table(spark, path, spark.createDataFrame([(dt.date(2005, 5, 1), "y", 7.0, "e2")], kind), ["d", "kind"], ["era"])
    assert done.written == [("e1",), ("e2",)]
    got = {(r.d.year, r.kind): (r.era, r.v) for r in spark.read.parquet(path).collect()}
    assert len(got) == 24 and got[2005, "y"] == ("e2", 7.0) and got[2005, "x"] == ("e1", 1.0)
