"""Segmented scans over time: gaps and runs without a global order.

A scan along a key's timeline is cut into segments that can be read apart.
Each segment leaves a summary (where it begins, where it ends, what is still
open at its edges), and the summaries alone are read in order to carry over
what crosses an edge. So no task holds a whole timeline, whatever the key:

* ``gap_scan`` first folds time into cells as wide as the gap that is looked
  for. Within a cell no such gap can lie, so a cell is its first and last
  instant: an aggregate with a partial step, which also takes care of instants
  that very many rows share. Cells are then scanned block by block.
* ``run_scan`` numbers the buckets of a timeline and finds the runs of
  consecutive numbers block by block; only runs that touch a block's edge are
  joined with those of the neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells or buckets of a block: the rows of one sort, and by how much summaries are fewer than cells.
BLOCK = 1 << 16


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch of a date or timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def _floor_div(c: Column, by: int) -> Column:
    """Whole quotient towards minus infinity, in 64-bit integers."""
    return F.call_function("div", c - F.pmod(c, F.lit(by)), F.lit(by)) if by > 1 else c


def gap_scan(df: DataFrame, ts: str, threshold_us: int, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """``(by..., gap_start, gap_end)``: neighbouring distinct instants of a
    ``by`` group more than ``threshold_us`` microseconds apart.

    Null instants are left out; a null ``by`` value is a group. Two hash
    exchanges, of which the first has a partial aggregate before it and the
    second carries at most one row per cell, and the exchange of the block
    summaries.
    """
    by = list(by)
    cell = _floor_div(micros(ts), max(int(threshold_us), 1))
    d = df.where(F.col(ts).isNotNull()).select(*by, F.col(ts).alias("_t"), cell.alias("_cell"))
    cells = d.groupBy(*by, "_cell").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
    cells = cells.withColumn("_block", _floor_div(F.col("_cell"), block))
    within = Window.partitionBy(*by, "_block")
    x = cells.select(
        *by, "_lo", "_hi", F.lead("_lo").over(within.orderBy("_cell")).alias("_next"), F.min("_lo").over(within).alias("_first")
    )
    inner = x.where(F.col("_next").isNotNull()).select(*by, F.col("_hi").alias("gap_start"), F.col("_next").alias("gap_end"))
    # a block's last cell carries the block's summary: its first and its last instant
    summary = x.where(F.col("_next").isNull()).select(*by, "_first", "_hi")
    after = F.lead("_first").over(Window.partitionBy(*by).orderBy("_first"))
    across = summary.select(*by, F.col("_hi").alias("gap_start"), after.alias("gap_end")).where(F.col("gap_end").isNotNull())
    return inner.unionByName(across).where(micros("gap_end") - micros("gap_start") > F.lit(int(threshold_us)))


def run_scan(df: DataFrame, ts: str, step_us: int, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """``(by..., run_start, run_end, n)``: maximal runs of instants exactly
    ``step_us`` apart; repeated instants count once, null ones not at all.

    One hash exchange on the group and block, whose clustering the runs'
    aggregate shares, and the exchange of the runs at block edges.
    """
    by = list(by)
    us = micros(ts)
    keys = [*by, "_phase"]  # instants off the step's raster run beside it, not with it
    d = df.where(F.col(ts).isNotNull()).select(
        *by, F.col(ts).alias("_t"), F.pmod(us, F.lit(step_us)).alias("_phase"), _floor_div(us, step_us).alias("_i")
    )
    d = d.withColumn("_block", _floor_div(F.col("_i"), block))
    rank = F.dense_rank().over(Window.partitionBy(*keys, "_block").orderBy("_i"))
    runs = d.withColumn("_run", F.col("_i") - rank).groupBy(*keys, "_block", "_run").agg(
        F.min("_t").alias("run_start"), F.max("_t").alias("run_end"), F.min("_i").alias("_a"), F.max("_i").alias("_z")
    )
    at_edge = (F.col("_a") == F.col("_block") * block) | (F.col("_z") == F.col("_block") * block + (block - 1))
    in_order = Window.partitionBy(*keys).orderBy("_a")
    begins = F.coalesce(F.lag("_z").over(in_order) + 1 != F.col("_a"), F.lit(True)).cast("int")
    carried = runs.where(at_edge).withColumn("_new", begins)
    carried = carried.withColumn("_chain", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = carried.groupBy(*keys, "_chain").agg(
        F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), (F.max("_z") - F.min("_a") + 1).alias("n")
    )
    closed = runs.where(~at_edge).select(*by, "run_start", "run_end", (F.col("_z") - F.col("_a") + 1).alias("n"))
    return closed.unionByName(joined.select(*by, "run_start", "run_end", "n"))
