"""Hour-bucket aggregation and the hourly join, batch and streaming.

The batch form is the source of truth; the streaming form is the same
aggregation over ``readStream`` with a watermark, emitted in append mode once
an hour can no longer change. Rows later than the watermark are dropped by
the streaming form (the batch rebuild still includes them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.functions.numeric import exact_sum
from ampere.operators.joins import sides


def hourly_window_agg(df: DataFrame, ts: str, by: Sequence[str], value: str) -> DataFrame:
    """(window_start, window_end, by..., n, total) per one-hour tumbling window."""
    w = F.window(F.col(ts), "1 hour")
    g = df.filter(F.col(ts).isNotNull()).groupBy(w.alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n"), exact_sum(value).alias("total")
    )
    return g.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *by,
        "n",
        "total",
    )


def hourly_stream(
    stream: DataFrame, ts: str, by: Sequence[str], value: str, watermark: str = "2 hours"
) -> DataFrame:
    """Streaming form: the watermark column must be TIMESTAMP (not NTZ)."""
    s = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    w = F.window(F.col("_ts"), "1 hour")
    g = s.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), exact_sum(value).alias("total"))
    return g.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *by,
        "n",
        "total",
    )


def hourly_join_stream(
    left: DataFrame,
    right: DataFrame,
    left_hour: str = "hour",
    right_ts: str = "ts",
    right_cols: Sequence[str] | None = None,
    prefix: str = "gw_",
    rename: dict[str, str] | None = None,
    left_flag: str = "has_left",
    right_flag: str = "has_right",
    watermark: str = "2 hours",
) -> DataFrame:
    """Streaming form of ``joins.hourly_full_outer`` over two streams (append mode).

    Both sides keep state for the hours that can still change, that is those
    not older than the newest hour of the slower side less ``watermark``. A
    pair of rows leaves as soon as both are there; a row whose hour has no
    partner leaves alone when its hour is closed, and its state goes. So rows
    may be late on either side up to the watermark, and the rows written equal
    the batch join over the rows that came in time. Rows that come later, and
    rows without a time, which would never be closed, are left out; the hours
    still open stay in the state.
    """
    L, R, out_cols, _ = sides(left, right, left_hour, right_ts, right_cols, prefix, rename, left_flag, right_flag)
    hour = lambda c: F.col(c).cast("timestamp")  # noqa: E731  (watermarks are for TIMESTAMP)
    L = L.where("_lh IS NOT NULL").withColumn("_lh", hour("_lh")).withWatermark("_lh", watermark)
    R = R.where("_rh IS NOT NULL").withColumn("_rh", hour("_rh")).withWatermark("_rh", watermark)
    joined = L.join(R, F.expr("_lh = _rh"), "full_outer").selectExpr(*out_cols)
    return joined.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
