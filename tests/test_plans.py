"""Plan-shape checks: the physical plans keep the properties the design
relies on at scale (see README, "Design for scale")."""

import pytest

import __spark_entry__ as E
from ampere.operators.reshape import plants_to_fuels

SF = "/root/testdata/sf0.01"


def plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_before_shuffle(spark):
    p = plan(spark, "dedupe_composite")
    assert "WindowGroupLimit" in p and "Partial" in p
    part = p.index("Partial")
    assert p.index("Exchange hashpartitioning") < part  # partial limit sits below (before) the exchange


@pytest.mark.parametrize("name", ["anti_not_in", "anti_composite", "insert_absent", "upsert_by_key", "latest_rates_all"])
def test_no_nested_loop_joins(spark, name):
    assert "NestedLoop" not in plan(spark, name)


def test_date_range_is_pushed_to_parquet(spark):
    p = plan(spark, "date_range")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


@pytest.mark.parametrize("name", ["pivot_hourly", "plant_fuel_pivot", "monthly_avg", "coverage"])
def test_aggregates_are_partial_before_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def test_gaps_are_scanned_in_blocks(spark):
    """Cells, blocks and the block summaries: no other exchange, and no global order."""
    import re

    for name, summary in (("gaps_global", set()), ("gaps_by_key", {"user_id"})):
        p = plan(spark, name)
        assert "rangepartitioning" not in p and "partial_min" in p
        keys = {frozenset(re.findall(r"(\w+)#", k)) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)}
        assert keys - {frozenset(summary)} == {frozenset({"_cell"} | summary), frozenset({"_block"} | summary)}


def test_ranges_are_found_in_blocks(spark):
    p = plan(spark, "backfill_ranges")
    assert "hashpartitioning(_phase" in p and "_block" in p


def test_split_full_outer_has_no_full_outer_join(spark):
    assert "FullOuter" not in plan(spark, "fct_intensity")


def test_plant_to_fuel_sums_do_not_shuffle(spark):
    cols = ", ".join(f"`PLANT {i} HYDRO` double" for i in range(200))
    wide = spark.createDataFrame([], f"timestamp timestamp_ntz, {cols}, TOTAL double")
    p = plants_to_fuels(wide, ["timestamp"], None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p


def test_cluster_conf_scales_partitions():
    from ampere.session import MB, cluster_conf

    small = cluster_conf(10 * MB)
    big = cluster_conf(100 * 1024**4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "200000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * MB)


def test_hot_hour_is_split_by_aqe(spark):
    """One hour holds a third of the reading rows: the split strategy's left
    outer join is marked skewed and split by AQE, and the result equals the
    native FULL OUTER join (which AQE cannot split)."""
    from pyspark.sql import functions as F

    from ampere.operators.joins import hourly_full_outer

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        right = spark.range(0, 120000).select(
            F.when(F.col("id") % 3 == 0, base)
            .otherwise(F.timestamp_add("MINUTE", (F.col("id") % 6000).cast("int"), base))
            .alias("ts"),
            F.col("id").cast("double").alias("v"),
        )
        left = spark.range(0, 200).select(
            F.timestamp_add("HOUR", F.col("id").cast("int"), base).alias("hour"), F.col("id").alias("g")
        )
        split = hourly_full_outer(left, right, "hour", "ts", right_cols=["v"])
        agg = split.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.count_if("has_left").alias("l"))
        got = agg.collect()[0]
        final = agg._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
        native = hourly_full_outer(left, right, "hour", "ts", right_cols=["v"], strategy="native")
        exp = native.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.count_if("has_left").alias("l")).collect()[0]
        assert tuple(got) == tuple(exp)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
