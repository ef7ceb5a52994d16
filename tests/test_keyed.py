"""Keyed operators: dedupe, upsert, insert-if-absent, NOT IN, anti joins."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ampere.operators import keyed
from ampere.sinks.tables import insert_absent_table, upsert_table

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 2), st.integers(-5, 5)), min_size=0, max_size=30
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_st)
def test_dedupe_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, p int, v int")
    got = sorted(
        (tuple(r) for r in keyed.dedupe_latest(df, ["k"], [F.col("p").desc(), F.col("v").desc()]).collect()),
        key=str,
    )
    best = {}
    for k, p, v in rows:
        if k not in best or (p, v) > best[k][1:]:
            best[k] = (k, p, v)
    assert got == sorted(best.values(), key=str)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=8), st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=8))
def test_not_in_is_null_aware(spark, batch, target):
    b = spark.createDataFrame([(x,) for x in batch], "k int")
    t = spark.createDataFrame([(x,) for x in target], "k int")
    got = sorted((r[0] for r in keyed.not_in(b, t, "k").collect()), key=lambda x: (x is None, x))
    # SQL three-valued NOT IN, by brute force
    exp = []
    for x in batch:
        if not target:
            exp.append(x)
        elif any(y is None for y in target):
            continue
        elif x is None:
            continue
        elif x not in target:
            exp.append(x)
    assert got == sorted(exp, key=lambda x: (x is None, x))


def test_upsert_replaces_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k int, v double")
    batch = spark.createDataFrame([(2, 21.0), (4, 40.0), (4, 41.0)], "k int, v double")
    once = keyed.upsert(target, batch, ["k"], batch_order=[F.col("v").desc()])
    twice = keyed.upsert(once, batch, ["k"], batch_order=[F.col("v").desc()])
    exp = [(1, 10.0), (2, 21.0), (3, 30.0), (4, 41.0)]
    assert sorted(map(tuple, once.collect())) == exp
    assert sorted(map(tuple, twice.collect())) == exp


def test_insert_by_name_keeps_existing(spark):
    target = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0), 5.0, "x")], "timestamp timestamp_ntz, nuclear_mw double, extra_col string")
    batch = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0), 99.0), (dt.datetime(2024, 1, 1, 1), 6.0)], "timestamp timestamp_ntz, nuclear_mw double"
    )
    out = sorted(map(tuple, keyed.insert_absent(target, batch, ["timestamp"]).collect()))
    assert out == [(dt.datetime(2024, 1, 1, 0), 5.0, "x"), (dt.datetime(2024, 1, 1, 1), 6.0, None)]


def test_insert_absent_null_key_in_target_blocks_all(spark):
    target = spark.createDataFrame([(None, 1.0)], "k int, v double")
    batch = spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert keyed.insert_absent(target, batch, ["k"]).count() == 1  # NOT IN with a NULL: nothing added


def test_anti_join_composite_and_null_contract(spark):
    b = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "x int, y string")
    t = spark.createDataFrame([(1, "a")], "x int, y string")
    assert sorted(map(tuple, keyed.anti_join(b, t, ["x", "y"]).collect())) == [(1, "b"), (2, "a")]
    bad = spark.createDataFrame([(None, "a")], "x int, y string")
    with pytest.raises(Exception, match="NULL key"):
        keyed.anti_join(bad, t, ["x", "y"]).collect()
    # the plan is an equi join, never a nested loop
    plan = keyed.anti_join(b, t, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_union_priority_optional_sides(spark):
    live = spark.createDataFrame([(1, 1.0)], "k int, v double")
    out = keyed.latest_by_priority((None, 0), (live, 1), keys=["k"])
    assert out.columns == ["k", "v"] and out.count() == 1


def test_upsert_table_touches_only_batch_partitions(spark, scratch):
    path = f"{scratch}/t"
    rows = [(i, f"2024-0{m}", float(i)) for m in (1, 2, 3) for i in range(m * 10, m * 10 + 3)]
    spark.createDataFrame(rows, "k int, month string, v double").write.partitionBy("month").parquet(path)
    batch = spark.createDataFrame([(20, "2024-02", -1.0), (99, "2024-02", 9.0)], "k int, month string, v double")
    from ampere.sinks.tables import touched_partitions

    pruned = touched_partitions(spark.read.parquet(path), [("2024-02",)], ["month"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "= 2024-02" in plan  # static pruning
    upsert_table(spark, path, batch, ["k"], partition_by=["month"])
    out = spark.read.parquet(path)
    got = {(r.k, r.v) for r in out.collect()}
    assert (20, -1.0) in got and (99, 9.0) in got and (20, 20.0) not in got
    assert out.count() == len(rows) + 1
    # idempotent replay
    upsert_table(spark, path, batch, ["k"], partition_by=["month"])
    assert spark.read.parquet(path).count() == len(rows) + 1


def test_insert_absent_table(spark, scratch):
    from pyspark.sql import types as T

    path = f"{scratch}/h"
    schema = T.StructType([T.StructField("timestamp", T.TimestampNTZType()), T.StructField("nuclear_mw", T.DoubleType()), T.StructField("extra_col", T.StringType())])
    batch = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0)], "timestamp timestamp_ntz, nuclear_mw double")
    insert_absent_table(spark, path, batch, ["timestamp"], schema=schema)
    insert_absent_table(spark, path, batch, ["timestamp"], schema=schema)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 1 and rows[0].extra_col is None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(-1000, 1000), st.integers(-1000, 1000)), min_size=1, max_size=20, unique_by=lambda r: r[0]))
def test_melt_then_pivot_round_trip(spark, rows):
    from ampere.operators.reshape import melt, pivot_sum

    wide = spark.createDataFrame([(k, a / 100, b / 100) for k, a, b in rows], "k int, a double, b double")
    long = melt(wide, ["k"], ["a", "b"], "var", "val")
    assert long.count() == 2 * len(rows)
    back = pivot_sum(long, ["k"], "var", "val", ["a", "b"], exact_scale=2)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 8), st.integers(-50, 50)), max_size=12, unique_by=lambda r: r[0]),
    st.lists(st.tuples(st.integers(0, 8), st.integers(-50, 50)), max_size=12, unique_by=lambda r: r[0]),
)
def test_upsert_properties(spark, target_rows, batch_rows):
    t = spark.createDataFrame(target_rows, "k int, v int")
    b = spark.createDataFrame(batch_rows, "k int, v int")
    once = sorted(map(tuple, keyed.upsert(t, b, ["k"]).collect()))
    twice = sorted(map(tuple, keyed.upsert(keyed.upsert(t, b, ["k"]), b, ["k"]).collect()))
    expected = dict(target_rows)
    expected.update(dict(batch_rows))  # batch rows win
    assert once == sorted(expected.items()) and twice == once
