"""Report operators behind the dashboard queries.

All are one-shuffle aggregates with a map-side partial step, or top-N
(``TakeOrderedAndProject``: a bounded heap per task, no global sort).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.functions.numeric import EXACT_SCALE, exact_avg, exact_avg_sql, round_half_away, round_half_away_sql
from ampere.functions.time import trunc_ntz


def _lit_ts(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, dt.datetime):
        return F.lit(x).cast("timestamp_ntz")
    if isinstance(x, dt.date):
        return F.lit(x).cast("timestamp_ntz")
    return F.lit(str(x)).cast("timestamp_ntz")


def max_value(df: DataFrame, col: str) -> Column:
    """``(SELECT max(col) FROM df)`` as a lazily evaluated scalar subquery."""
    return df.select(F.max(col)).scalar()


def trailing(df: DataFrame, ts: str, days: int, anchor=None) -> DataFrame:
    """Rows with ``ts >= anchor - days``; the anchor is the data's own max by
    default (P13), or a given wall-clock instant / Column (P14). Pass a
    cheaper anchor (for example ``hour_anchor(raw, 'ts')``) when ``df`` is an
    aggregate, so the scalar subquery does not recompute it."""
    a = max_value(df, ts) if anchor is None else _lit_ts(anchor)
    return df.filter(F.col(ts) >= a - F.make_dt_interval(F.lit(days)))


def hour_anchor(raw: DataFrame, ts: str) -> Column:
    """``max(date_trunc('hour', ts))`` of an hourly aggregate, computed from its
    raw input as ``date_trunc('hour', max(ts))`` (truncation is monotone): a
    one-column scan instead of re-running the aggregate."""
    return raw.select(trunc_ntz("hour", F.max(ts))).scalar()


def clip(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Inclusive date range on the date of ``ts`` (P10), written as a sargable
    half-open timestamp range so the bounds reach the Parquet scan. A bound is
    a day, whatever its type: a time of day in it is not used, so the first
    and the last day are whole."""
    lo, hi = _lit_ts(_day(start)), _lit_ts(_day(end) + dt.timedelta(days=1))
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def _day(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x)[:10])


def bucket(grain: str, ts: str) -> Column:
    if grain == "year":
        return F.year(F.col(ts)).cast("bigint")
    if grain == "date":
        return F.col(ts).cast("date")
    return trunc_ntz(grain, F.col(ts))


def avg_by(
    df: DataFrame,
    grain: str,
    ts: str,
    measures: dict[str, str],
    digits: int | None = None,
    exact_scale: int | None = EXACT_SCALE,
    out_key: str | None = None,
) -> DataFrame:
    """Average per time bucket (A5–A7). ``measures`` maps output name → column.
    Averages are computed from exact decimal sums (order-independent) and
    optionally rounded half away from zero."""
    key = out_key or grain
    aggs = []
    for name, col in measures.items():
        a = exact_avg(col, exact_scale) if exact_scale is not None else F.avg(col)
        aggs.append((round_half_away(a, digits) if digits is not None else a).alias(name))
    return df.groupBy(bucket(grain, ts).alias(key)).agg(*aggs)


def stats_by(df: DataFrame, grain: str, ts: str, measure: str, prefix: str, digits: int = 1) -> DataFrame:
    """avg / min / max of one measure per bucket, NULLs excluded."""
    m = f"`{measure}`"
    d = df.where(f"{m} IS NOT NULL")
    return d.groupBy(bucket(grain, ts).alias(grain)).agg(
        F.expr(f"{round_half_away_sql(exact_avg_sql(m), digits)} AS avg_{prefix}"),
        F.expr(f"{round_half_away_sql(f'min({m})', digits)} AS min_{prefix}"),
        F.expr(f"{round_half_away_sql(f'max({m})', digits)} AS max_{prefix}"),
    )


def newest_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top-N by an explicit, total order (L1–L3): give a tie-breaking key so
    ties at the cut are resolved deterministically."""
    return df.orderBy(*order).limit(n)


def latest_for_category(df: DataFrame, cat_col: str, cat_value, date_col: str) -> DataFrame:
    """Rows of one category at that category's latest date."""
    d = df.filter(F.col(cat_col) == F.lit(cat_value))
    return d.filter(F.col(date_col) == max_value(d, date_col))


def latest_per_category(df: DataFrame, cat_col: str, date_col: str) -> DataFrame:
    """Rows at each category's latest date. A grouped max (partial-aggregated,
    one row per category) joined back — not a window over the category, which
    would put a hot category's rows in one task."""
    latest = df.groupBy(cat_col).agg(F.max(date_col).alias("_latest"))
    j = df.join(latest, (df[cat_col].eqNullSafe(latest[cat_col])) & (df[date_col] == latest["_latest"]), "left_semi")
    return j
