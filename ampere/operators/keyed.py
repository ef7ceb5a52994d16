"""Keyed-table operators: dedupe, upsert, insert-if-absent, NOT IN.

Scale notes
* ``dedupe_latest`` / ``dedupe_first`` are ``row_number() = 1`` windows, which
  Catalyst plans with a partial ``WindowGroupLimit`` *before* the shuffle: each
  map task keeps one row per key, so a hot key ships at most one row per map
  partition instead of all its rows.
* ``upsert`` filters the target by a left-anti join on the batch's keys. Spark
  broadcasts the keys below its byte threshold, by estimate or at run time;
  beyond it the join is a sort-merge join, which AQE can split when a key is
  skewed.
* ``not_in`` is exact SQL ``NOT IN`` (null-aware) without the nested-loop join
  Spark falls back to for non-broadcastable ``NOT IN`` subqueries: an equi
  anti join plus two ``EXISTS`` scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.operators.common import require_non_null

PRIORITY = "_priority"


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per key under ``order`` (put ``desc`` terms first for
    latest-wins). NULL keys form one group. Give a total order for determinism.

    ``order`` holds Columns or SQL sort terms (``"ts DESC NULLS LAST"``); with
    SQL terms the window is a single expression (one JVM call to build)."""
    if all(isinstance(o, str) for o in order):
        spec = f"PARTITION BY {', '.join(_q(k) for k in keys)} ORDER BY {', '.join(order)}"
        rn = F.expr(f"row_number() OVER ({spec})")
    else:
        rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*_cols(order)))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First-wins dedupe on key (A10): the first row in ascending ``order``."""
    return dedupe_latest(df, keys, [f"{_q(c)} ASC NULLS FIRST" for c in order])


def union_by_priority(*sides: tuple[DataFrame | None, int]) -> DataFrame:
    """UNION ALL of optional inputs, each tagged with a constant priority."""
    present = [df.withColumn(PRIORITY, F.lit(p)) for df, p in sides if df is not None]
    if not present:
        raise ValueError("union_by_priority needs at least one input")
    out = present[0]
    for df in present[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def latest_by_priority(
    *sides: tuple[DataFrame | None, int], keys: Sequence[str], tiebreak: Sequence = ()
) -> DataFrame:
    """U1 + Q1: highest priority wins per key; the priority column is dropped."""
    u = union_by_priority(*sides)
    first = f"{PRIORITY} DESC" if all(isinstance(x, str) for x in tiebreak) else F.col(PRIORITY).desc()
    return dedupe_latest(u, keys, [first, *tiebreak]).drop(PRIORITY)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    batch_order: Sequence | None = None,
) -> DataFrame:
    """Keyed merge (K1): each batch row replaces the stored row with its key.

    ``batch_order`` (latest first) resolves several batch rows with one key;
    without it the row of least hash stays, so a repeated run keeps the same.
    """
    b = one_per_key(batch, keys, batch_order)
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(b, allowMissingColumns=True)


def one_per_key(batch: DataFrame, keys: Sequence[str], batch_order: Sequence | None = None) -> DataFrame:
    """One batch row per key, by ``batch_order`` or else by hash."""
    return dedupe_latest(batch, list(keys), batch_order or [F.xxhash64(*batch.columns)])


def not_in(batch: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """``batch WHERE key NOT IN (SELECT target_key FROM target)`` (J2), null-aware:
    one NULL in the target empties the result; a NULL batch key survives only
    when the target is empty."""
    tk = target_key or key
    t = target.select(F.col(tk).alias("_nk"))
    target_has_null = t.filter(F.col("_nk").isNull()).exists()
    target_nonempty = t.exists()
    anti = batch.join(t.filter(F.col("_nk").isNotNull()), F.col(key) == F.col("_nk"), "left_anti")
    return anti.filter(~target_has_null & (F.col(key).isNotNull() | ~target_nonempty))


def anti_join(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Composite-key ``NOT IN`` (J3) for keys that are non-NULL by contract:
    validated at run time, then an equi left-anti join (never the O(n*m)
    nested loop a tuple ``NOT IN`` plans)."""
    keys = list(keys)
    b = require_non_null(batch, keys)
    t = require_non_null(target.select(*keys), keys)
    return b.join(t, keys, "left_anti")


def insert_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], batch_order: Sequence[str] | None = None
) -> DataFrame:
    """K4: append batch rows whose key is absent from the target, by column
    name; columns missing on either side become NULL; existing rows win.

    ``batch_order`` dedupes the batch first-wins (A10). The anti join runs
    before the dedupe — equivalent, since it depends on the key only — so
    keys already stored never reach the dedupe's shuffle and sort."""
    new_rows = new_rows_absent(target, batch, keys)
    if batch_order:
        new_rows = dedupe_first(new_rows, list(keys), batch_order)
    return target.unionByName(new_rows, allowMissingColumns=True)


def new_rows_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the rows :func:`insert_absent` would append (for append-mode writes)."""
    keys = list(keys)
    return not_in(batch, target, keys[0]) if len(keys) == 1 else anti_join(batch, target, keys)
