"""Cursor-based incremental load (I1), batch form.

The cursor is the target's max timestamp; the source is read from the first
day of the cursor's month (the boundary month is re-read) and merged by key.
On a month-partitioned source the month bound is a partition filter, so only
the new months are scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.functions.time import trunc_ntz
from ampere.operators.keyed import upsert

# Cursor start of the generation source when the target is empty.
INITIAL_CURSOR = "2019-05-01 00:00:00"


def incremental_merge(
    target: DataFrame,
    source: DataFrame,
    ts: str,
    keys: Sequence[str],
    initial: str = INITIAL_CURSOR,
    batch_order: Sequence | None = None,
    month_col: str | None = None,
) -> DataFrame:
    """Merge the source rows from the cursor's month onwards into the target.

    ``month_col`` names a ``yyyy-MM`` partition column of the source: the
    same bound is then also a partition filter, so the scan skips the months
    before the cursor (the subquery is evaluated before the scan lists files).
    """
    cursor = target.select(F.max(ts)).scalar()
    start = trunc_ntz("month", F.coalesce(cursor, F.lit(initial).cast("timestamp_ntz")))
    batch = source.filter(F.col(ts) >= start)
    if month_col:
        batch = batch.filter(F.col(month_col) >= F.date_format(start, "yyyy-MM"))
    return upsert(target, batch, keys, batch_order)
