"""Mergeable summaries of a partitioned table.

Each partition is summarised once, in one pass over it: counters (rows, nulls,
values below and above their bounds, distinct time buckets), the least and the
greatest value, a sketch of distinct values and a sketch of quantiles. The
summaries are stored; a check merges them and reads only partitions that have
no summary yet or whose files have changed. Counters merge exactly. Distinct
values are estimated by HyperLogLog with 2**12 buckets (standard error 1.6 %),
quantiles by a KLL sketch with k = 200 (rank error 1.7 % at 99 %
confidence), however many partitions are merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.functions.numeric import round_half_away
from ampere.functions.time import trunc_ntz
from ampere.operators.quality import STEP_UNITS

HLL_BITS, KLL_K = 12, 200


@dataclass(frozen=True)
class Spec:
    """What is counted: numeric columns, their bounds where they have some, and
    the time column whose buckets of ``step_seconds`` are covered. Buckets of
    two partitions must differ, as those of month partitions do."""

    columns: tuple[str, ...]
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    ts: str | None = None
    step_seconds: int = 3600


def summarise(df: DataFrame, spec: Spec, by: Sequence[str] = ()) -> DataFrame:
    """``by...`` and a row per column: the table's own aggregate, one pass."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    if spec.ts:
        unit = trunc_ntz(STEP_UNITS[spec.step_seconds], spec.ts)
        aggs += [F.min(unit).alias("first_bucket"), F.max(unit).alias("last_bucket"), F.count_distinct(unit).alias("buckets")]
    for i, c in enumerate(spec.columns):
        v = F.col(f"`{c}`").cast("double")
        low, high = spec.bounds.get(c, (None, None))
        aggs += [
            F.count_if(v.isNull()).alias(f"nulls{i}"),
            F.count_if(v < F.lit(low).cast("double")).alias(f"below{i}"),
            F.count_if(v > F.lit(high).cast("double")).alias(f"above{i}"),
            F.min(v).alias(f"least{i}"), F.max(v).alias(f"greatest{i}"),
            # as text, so that equal values of any numeric type are one
            F.hll_sketch_agg(v.cast("string"), F.lit(HLL_BITS)).alias(f"distinct{i}"),
            F.kll_sketch_agg_double(F.when(~F.isnan(v), v), KLL_K).alias(f"quantiles{i}"),
        ]
    one = df.groupBy(*by).agg(*aggs)
    names = ("nulls", "below", "above", "least", "greatest", "distinct", "quantiles")
    each = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i, c in enumerate(spec.columns)]
    span = ["first_bucket", "last_bucket", "buckets"] if spec.ts else []
    return one.select(*by, "rows", *span, F.explode(F.array(*each)).alias("_s")).select(*by, "rows", *span, "_s.*")


def merge(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summaries of disjoint parts → one per column (and ``by``), of the same form."""
    span = []
    if "buckets" in summaries.columns:
        span = [F.min("first_bucket").alias("first_bucket"), F.max("last_bucket").alias("last_bucket"), F.sum("buckets").alias("buckets")]
    return summaries.groupBy(*by, "column_name").agg(
        F.sum("rows").alias("rows"), *span, *[F.sum(n).alias(n) for n in ("nulls", "below", "above")],
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles", KLL_K).alias("quantiles"),
    )


def refresh(spark: SparkSession, table: str, store: str, spec: Spec, partition_by: Sequence[str]) -> list[tuple[str | None, ...]]:
    """Summarise the partitions of a stored table that have no summary in
    ``store`` or other files than it was made from; returns these partitions.
    Summaries of partitions that are gone are not merged (``stored``)."""
    from ampere.sinks import key_index
    from ampere.sinks.tables import touched_partitions

    files = key_index.partition_files(spark, table, partition_by)
    stale = sorted(set(files) - key_index.fresh_in(spark, store, files))
    if stale:
        rows = touched_partitions(spark.read.parquet(table), [key_index.values(p) for p in stale], partition_by)
        rows = rows.withColumn("part", key_index.part_of(partition_by))
        new = summarise(rows, spec, ["part"]).join(key_index.known(spark, files), "part")
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(store)
    return [key_index.values(p) for p in stale]


def stored(spark: SparkSession, table: str, store: str, partition_by: Sequence[str]) -> DataFrame:
    """The stored summaries of the partitions as they are now."""
    from ampere.sinks import key_index

    files = key_index.partition_files(spark, table, partition_by)
    return spark.read.parquet(store).join(key_index.known(spark, files), ["part", "files"], "left_semi")


# ── checks over merged summaries ─────────────────────────────────────────────


def null_share(merged: DataFrame, max_pct: float = 5.0) -> DataFrame:
    """As ``quality.null_share``."""
    pct = F.col("nulls").cast("double") * F.lit(100.0) / F.nullif(F.col("rows"), F.lit(0)).cast("double")
    severity = F.when(pct > max_pct, F.lit("error")).otherwise(F.lit("ok"))
    return merged.select(
        "column_name", "rows", F.col("nulls").alias("null_count"), round_half_away(pct, 3).alias("null_pct"), severity.alias("severity")
    )


def range_violations(merged: DataFrame, spec: Spec) -> DataFrame:
    """As ``quality.range_violations``."""
    bounds = F.create_map(*[F.lit(x) for c, (lo, hi) in spec.bounds.items() for x in (c, f"{float(lo)!r}|{float(hi)!r}")])
    parts = F.split(F.try_element_at(bounds, "column_name"), "[|]")
    found = F.col("below") + F.col("above")
    return merged.where(F.col("column_name").isin(list(spec.bounds))).select(
        "column_name", parts[0].cast("double").alias("lo"), parts[1].cast("double").alias("hi"), found.alias("violations"),
        F.when(found > 0, F.lit("error")).otherwise(F.lit("ok")).alias("severity"),
    )


def coverage(merged: DataFrame, spec: Spec, tolerance: float = 0.95) -> DataFrame:
    """As ``quality.coverage`` of the whole table."""
    seconds = F.unix_micros(F.col("last_bucket").cast("timestamp")) - F.unix_micros(F.col("first_bucket").cast("timestamp"))
    expected = (seconds / (spec.step_seconds * 1_000_000)).cast("bigint") + 1
    ratio = F.col("buckets").cast("double") / expected.cast("double")
    return merged.select(
        "first_bucket", "last_bucket", F.col("buckets").alias("buckets_found"), "rows", expected.alias("buckets_expected"),
        round_half_away(ratio, 4).alias("coverage"), (ratio >= tolerance).alias("complete"),
    ).limit(1)  # every column's summary has the same span


def distinct_and_quantiles(merged: DataFrame, ranks: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Estimated distinct values and quantiles per column, for drift checks."""
    cuts = [F.kll_sketch_get_quantile_double("quantiles", F.lit(float(r))).alias(f"q{round(100 * r):02d}") for r in ranks]
    return merged.select("column_name", "rows", "least", "greatest", F.hll_sketch_estimate("distinct").alias("distinct_values"), *cuts)


# ── run-log summaries (C9) ───────────────────────────────────────────────────


def run_summary(runs: DataFrame, by: Sequence[str] = (), source: str = "source", status: str = "status", ts: str = "timestamp") -> DataFrame:
    """Counters per source that merge: runs, successes, failures, last times."""
    ok = F.col(status) == "success"
    return runs.groupBy(*by, F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(ok).alias("successes"), F.count_if(F.col(status) == "failed").alias("failures"),
        F.max(ts).alias("last_run"), F.max(F.when(ok, F.col(ts))).alias("last_success"),
    )


def merge_runs(summaries: DataFrame) -> DataFrame:
    """As ``quality.health_summary``, from summaries of disjoint parts of a run log."""
    counts = [F.sum(c).alias(c) for c in ("runs", "successes", "failures")]
    out = summaries.groupBy("source").agg(*counts, F.max("last_run").alias("last_run"), F.max("last_success").alias("last_success"))
    return out.withColumn("success_rate", round_half_away(F.col("successes") * F.lit(100.0) / F.col("runs"), 1))
