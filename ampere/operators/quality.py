"""Data-quality, continuity and freshness operators.

Every check returns a small report DataFrame; nothing is collected to decide
*how* to compute. Scale notes:

* ``gaps`` and ``backfill_ranges`` never order a whole timeline: they scan it
  block by block and carry over the block summaries (``operators.segments``).
* ``missing_buckets`` expands the span in two levels (days, then buckets
  within a day) so generation is spread over tasks.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.functions.numeric import round_half_away
from ampere.functions.time import seconds_between, trunc_ntz
from ampere.operators.segments import BLOCK, gap_scan, run_scan

STEP_UNITS = {3600: "hour", 60: "minute", 86400: "day", 1: "second"}


def _lit_ts(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x if isinstance(x, (dt.datetime, dt.date)) else str(x)).cast("timestamp_ntz")


# ── C1, C2, A13/C3, C5 ───────────────────────────────────────────────────────


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: (column_name, rows, null_count, passed) — one scan."""
    agg = df.agg(
        F.expr("count(1) AS _rows"),
        *[F.expr(f"count_if(`{c}` IS NULL) AS _n{i}") for i, c in enumerate(cols)],
    )
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    long = agg.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column_name, null_count)")
    return long.select(
        "column_name",
        F.col("_rows").alias("rows"),
        F.col("null_count"),
        (F.col("null_count") == 0).alias("passed"),
    )


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, NULL keys ignored."""
    d = df
    for k in keys:
        d = d.filter(F.col(k).isNotNull())
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def null_share(df: DataFrame, cols: Sequence[str], max_pct: float = 5.0) -> DataFrame:
    """Percentage of NULLs per column; above ``max_pct`` is an error."""
    nn = check_not_null(df, cols)
    pct = F.col("null_count").cast("double") * F.lit(100.0) / F.nullif(F.col("rows"), F.lit(0)).cast("double")
    return nn.select(
        "column_name",
        "rows",
        "null_count",
        round_half_away(pct, 3).alias("null_pct"),
        F.when(pct > F.lit(max_pct), F.lit("error")).otherwise(F.lit("ok")).alias("severity"),
    )


def range_violations(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows outside [lo, hi] per column (C5); one scan for all columns."""
    names = list(bounds)
    agg = df.agg(
        *[
            F.expr(f"count_if(`{c}` < {float(lo)!r}D OR `{c}` > {float(hi)!r}D) AS _v{i}")
            for i, (c, (lo, hi)) in enumerate(bounds.items())
        ]
    )
    stack = ", ".join(
        f"'{c}', CAST({float(lo)!r} AS DOUBLE), CAST({float(hi)!r} AS DOUBLE), _v{i}"
        for i, (c, (lo, hi)) in enumerate(bounds.items())
    )
    long = agg.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, lo, hi, violations)")
    return long.withColumn(
        "severity", F.when(F.col("violations") > 0, F.lit("error")).otherwise(F.lit("ok"))
    )


# ── C4 ───────────────────────────────────────────────────────────────────────


def row_count_regression(
    counts: DataFrame, by: Sequence[str], order: str, count_col: str, max_drop: float = 0.10
) -> DataFrame:
    """Compare each count with the previous one in ``order`` per ``by`` group
    (C4); a drop larger than ``max_drop`` is an error. ``counts`` is already
    aggregated (one row per period), so the window is over small data."""
    w = Window.partitionBy(*by).orderBy(order)
    prev = F.lag(count_col).over(w)
    out = counts.withColumn("prev_count", prev)
    drop = F.lit(1.0) - F.col(count_col).cast("double") / F.col("prev_count").cast("double")
    return out.withColumn("drop_pct", round_half_away(drop * F.lit(100.0), 2)).withColumn(
        "severity",
        F.when(F.col(count_col) < F.col("prev_count") * F.lit(1.0 - max_drop), F.lit("error")).otherwise(
            F.lit("ok")
        ),
    )


# ── Q2 gaps ──────────────────────────────────────────────────────────────────


def gaps(
    df: DataFrame,
    ts: str,
    threshold_seconds: float,
    by: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """Gaps between consecutive distinct timestamps (per ``by`` group) longer
    than ``threshold_seconds``: (by..., gap_start, gap_end, gap_seconds), by
    a segmented scan (``segments.gap_scan``)."""
    found = gap_scan(df, ts, math.floor(threshold_seconds * 1_000_000), by, block)
    return found.select(*by, "gap_start", "gap_end", seconds_between(F.col("gap_end"), F.col("gap_start")).alias("gap_seconds"))


# ── Q3 missing buckets, A12 coverage ─────────────────────────────────────────


def missing_buckets(
    df: DataFrame,
    ts: str,
    step_seconds: int = 3600,
    span: DataFrame | None = None,
    span_ts: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Buckets of ``step_seconds`` between the first and last bucket of the span
    (``span`` defaults to ``df``) that hold no row of ``df`` (Q3)."""
    unit = STEP_UNITS.get(step_seconds)
    if unit is None or 86400 % step_seconds:
        raise ValueError("step_seconds must be one of 1, 60, 3600, 86400")
    by = list(by)
    src = span if span is not None else df
    sts = span_ts or ts
    bounds = src.groupBy(*by).agg(
        trunc_ntz(unit, F.min(sts)).alias("_lo"), trunc_ntz(unit, F.max(sts)).alias("_hi")
    )
    days = bounds.select(
        *by, "_lo", "_hi",
        F.explode(F.sequence(trunc_ntz("day", F.col("_lo")), trunc_ntz("day", F.col("_hi")), F.expr("INTERVAL 1 DAY"))).alias("_day"),
    )
    # spread the per-day expansion over the cluster's cores (a span is one row before this)
    days = days.repartition(df.sparkSession.sparkContext.defaultParallelism)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(step_seconds))
    day_end = F.col("_day") + F.expr("INTERVAL 1 DAY") - step
    all_b = days.select(
        *by, "_lo", "_hi", F.explode(F.sequence(F.col("_day"), day_end, step)).alias("bucket")
    ).where((F.col("bucket") >= F.col("_lo")) & (F.col("bucket") <= F.col("_hi")))
    present = df.select(*by, trunc_ntz(unit, F.col(ts)).alias("bucket")).where(F.col("bucket").isNotNull()).distinct()
    return all_b.select(*by, "bucket").join(present, [*by, "bucket"], "left_anti")


def backfill_ranges(
    missing: DataFrame, bucket: str = "bucket", step_seconds: int = 3600, by: Sequence[str] = (), block: int = BLOCK
) -> DataFrame:
    """Collapse missing buckets into contiguous ranges to re-fetch (I3):
    (by..., range_start, range_end, buckets), by a segmented scan
    (``segments.run_scan``), so that also without ``by`` no task holds all."""
    runs = run_scan(missing, bucket, step_seconds * 1_000_000, by, block)
    return runs.select(*by, F.col("run_start").alias("range_start"), F.col("run_end").alias("range_end"), F.col("n").alias("buckets"))


def coverage(
    df: DataFrame, ts: str, step_seconds: int = 3600, tolerance: float = 0.95, by: Sequence[str] = ()
) -> DataFrame:
    """Distinct buckets found vs buckets expected between first and last."""
    unit = STEP_UNITS[step_seconds]
    by = list(by)
    b = df.select(*by, trunc_ntz(unit, F.col(ts)).alias("_b")).where(F.col("_b").isNotNull())
    per_bucket = b.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    agg = per_bucket.groupBy(*by).agg(
        F.min("_b").alias("first_bucket"),
        F.max("_b").alias("last_bucket"),
        F.count(F.lit(1)).alias("buckets_found"),
        F.sum("_n").alias("rows"),
    )
    expected = (
        seconds_between(F.col("last_bucket"), F.col("first_bucket")) / F.lit(float(step_seconds))
    ).cast("bigint") + F.lit(1)
    ratio = F.col("buckets_found").cast("double") / F.col("buckets_expected").cast("double")
    return (
        agg.withColumn("buckets_expected", expected)
        .withColumn("coverage", round_half_away(ratio, 4))
        .withColumn("complete", ratio >= F.lit(tolerance))
    )


# ── I2 freshness ─────────────────────────────────────────────────────────────


def freshness(sources: dict[str, tuple[DataFrame | None, str, float]], asof) -> DataFrame:
    """One row per source: (source, last_update, age_seconds, threshold_seconds,
    is_fresh). Fresh means strictly younger than the threshold; a missing
    table, an empty one or only NULL timestamps is not fresh."""
    asof_c = _lit_ts(asof)
    parts = []
    for name, (df, col, threshold) in sources.items():
        if df is None:
            last = None
        else:
            last = df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("last_update"))
        parts.append((name, last, float(threshold)))
    spark = next((p[1].sparkSession for p in parts if p[1] is not None), None)
    out = None
    for name, last, thr in parts:
        if last is None:
            if spark is None:
                raise ValueError("freshness needs at least one existing table")
            last = spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("last_update"))
        row = last.select(
            F.lit(name).alias("source"),
            "last_update",
            seconds_between(asof_c, F.col("last_update")).alias("age_seconds"),
            F.lit(thr).alias("threshold_seconds"),
        ).withColumn(
            "is_fresh",
            F.coalesce(F.col("age_seconds") < F.col("threshold_seconds"), F.lit(False)),
        )
        out = row if out is None else out.unionByName(row)
    return out


# ── A11, C9 run-log reports ──────────────────────────────────────────────────


def repeat_failures(
    runs: DataFrame,
    source: str = "source",
    status: str = "status",
    ts: str = "timestamp",
    failed_value: str = "failed",
    min_failures: int = 3,
    period_days: int = 3,
    asof=None,
) -> DataFrame:
    """Sources with at least ``min_failures`` failed runs in the last
    ``period_days`` before ``asof`` (default: the log's own max time)."""
    a = runs.select(F.max(ts)).scalar() if asof is None else _lit_ts(asof)
    recent = runs.filter(
        (F.col(status) == F.lit(failed_value)) & (F.col(ts) > a - F.make_dt_interval(F.lit(period_days)))
    )
    return (
        recent.groupBy(F.col(source).alias("source"))
        .agg(F.count(F.lit(1)).alias("fail_count"))
        .filter(F.col("fail_count") >= min_failures)
    )


def health_summary(
    runs: DataFrame,
    source: str = "source",
    status: str = "status",
    ts: str = "timestamp",
    success_value: str = "success",
    failed_value: str = "failed",
) -> DataFrame:
    """Per source: runs, successes, failures, success rate (%), last run, last success."""
    ok = F.col(status) == F.lit(success_value)
    g = runs.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("successes"),
        F.count_if(F.col(status) == F.lit(failed_value)).alias("failures"),
        F.max(ts).alias("last_run"),
        F.max(F.when(ok, F.col(ts))).alias("last_success"),
    )
    return g.withColumn(
        "success_rate", round_half_away(F.col("successes") * F.lit(100.0) / F.col("runs"), 1)
    )


# ── C6, K7 schema checks, C8 gate ────────────────────────────────────────────


def schema_drift(expected: T.StructType, actual: T.StructType, spark, severity: str = "warning") -> DataFrame:
    """Rows (column_name, expected, actual, change, severity) for added, removed
    or retyped columns (C6). Schemas are metadata: this is a tiny frame."""
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for n in sorted(set(exp) | set(act)):
        e, a = exp.get(n), act.get(n)
        if e == a:
            continue
        change = "added" if e is None else "removed" if a is None else "retyped"
        rows.append((n, e, a, change, severity))
    schema = "column_name string, expected string, actual string, change string, severity string"
    return spark.createDataFrame(rows, schema)


class SchemaViolation(ValueError):
    pass


def enforce_schema(df: DataFrame, schema: T.StructType, mode: str = "freeze") -> DataFrame:
    """``freeze``: any new, missing or retyped column raises before a write (K7).
    ``by_name``: select the declared columns by name, NULL-filling absent
    ones and casting the rest."""
    if mode == "freeze":
        exp = {f.name: f.dataType for f in schema.fields}
        act = {f.name: f.dataType for f in df.schema.fields}
        if exp != act:
            raise SchemaViolation(f"schema drift: expected {schema.simpleString()}, got {df.schema.simpleString()}")
        return df.select(*schema.fieldNames())
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        c = F.col(f.name) if f.name in present else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def keyed_checks(
    df: DataFrame,
    key: str,
    null_cols: Sequence[str] = (),
    bounds: dict[str, tuple[float, float]] | None = None,
    max_null_pct: float = 5.0,
) -> DataFrame:
    """NULL share, range violations and key uniqueness of a keyed table in one
    pass (C2, C3, C5 → C8 rows: check_name, subject, value, severity).

    Counts are taken per key first — for a table already partitioned by the
    key (an hourly mart) that group needs no exchange — then summed."""
    bounds = bounds or {}
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(null_cols)],
        *[F.count_if((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(f"_rng{i}") for i, (c, (lo, hi)) in enumerate(bounds.items())],
    )
    null_keys = df.filter(F.col(key).isNull()).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(null_cols)],
        *[F.count_if((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(f"_rng{i}") for i, (c, (lo, hi)) in enumerate(bounds.items())],
    ).withColumn(key, F.lit(None).cast(df.schema[key].dataType))
    tot = per_key.unionByName(null_keys).agg(
        F.sum("_n").alias("_rows"),
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_dups"),
        *[F.sum(f"_null{i}").alias(f"_null{i}") for i in range(len(null_cols))],
        *[F.sum(f"_rng{i}").alias(f"_rng{i}") for i in range(len(bounds))],
    )
    rows = []
    for i, c in enumerate(null_cols):
        pct = F.col(f"_null{i}").cast("double") * F.lit(100.0) / F.col("_rows").cast("double")
        rows.append(F.struct(F.lit("null_share").alias("check_name"), F.lit(c).alias("subject"),
                             round_half_away(pct, 3).alias("value"),
                             F.when(pct > F.lit(max_null_pct), F.lit("error")).otherwise(F.lit("ok")).alias("severity")))
    for i, c in enumerate(bounds):
        v = F.coalesce(F.col(f"_rng{i}"), F.lit(0)).cast("double")
        rows.append(F.struct(F.lit("range").alias("check_name"), F.lit(c).alias("subject"), v.alias("value"),
                             F.when(v > 0, F.lit("error")).otherwise(F.lit("ok")).alias("severity")))
    dv = F.col("_dups").cast("double")
    rows.append(F.struct(F.lit("unique").alias("check_name"), F.lit(key).alias("subject"), dv.alias("value"),
                         F.when(dv > 0, F.lit("error")).otherwise(F.lit("ok")).alias("severity")))
    return tot.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def continuity_check(df: DataFrame, ts: str, max_gap_seconds: float, severity: str = "warning") -> DataFrame:
    """Count of gaps longer than ``max_gap_seconds`` as one check row."""
    n = gaps(df, ts, max_gap_seconds).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return n.select(
        F.lit("continuity").alias("check_name"), F.lit(ts).alias("subject"), "value",
        F.when(F.col("value") > 0, F.lit(severity)).otherwise(F.lit("ok")).alias("severity"),
    )


def validation_report(*checks: DataFrame) -> DataFrame:
    """Union of normalised check rows (check, subject, value, severity)."""
    out = None
    for c in checks:
        out = c if out is None else out.unionByName(c)
    return out


def publish(df: DataFrame, report: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` to ``path`` unless the report has an error row (C8); returns
    :func:`gate_exit_code`, 2 meaning that nothing was written."""
    from ampere.sinks.tables import replace_table

    code = gate_exit_code(report)
    if code < 2:
        replace_table(df, path, partition_by)
    return code


def gate_exit_code(report: DataFrame) -> int:
    """2 when any error row exists, 1 for warnings only, else 0 (bounded read)."""
    if report.filter(F.col("severity") == "error").limit(1).count():
        return 2
    if report.filter(F.col("severity") == "warning").limit(1).count():
        return 1
    return 0
