"""Hour-grain full outer join with provenance flags.

Two physical strategies with identical results:

* ``native``: one sort-merge FULL OUTER join. AQE cannot split skewed
  partitions of a full outer join, so one hot hour lands in one task.
* ``split`` (default): ``right ⟕ left`` UNION ALL ``left ▷ distinct(right.hour)``.
  The left outer join streams the right side (the one that can hold many rows
  per hour), which AQE's skew-join rule splits (measured: Spark 4.1 splits
  LEFT OUTER, not FULL OUTER); the anti join reads only the *distinct* right
  hours, pre-aggregated map-side, so a hot hour ships one row per map task.
  Cost: each input is read twice (the right side's second read is pruned to
  the hour column); stage inputs that are expensive to recompute (see
  ``plans.marts.build_marts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def hourly_full_outer(
    left: DataFrame,
    right: DataFrame,
    left_hour: str = "hour",
    right_ts: str = "ts",
    right_cols: Sequence[str] | None = None,
    prefix: str = "gw_",
    rename: dict[str, str] | None = None,
    left_flag: str = "has_left",
    right_flag: str = "has_right",
    strategy: str = "split",
) -> DataFrame:
    """``coalesce(l.hour, date_trunc('hour', r.ts)) AS hour``, all left
    columns, the chosen right columns (a right column whose name collides with
    a left one gets ``prefix``; ``rename`` overrides), and two flags.

    Duplicate rows per hour on either side fan out, NULL keys never match and
    survive with a NULL hour, as in SQL."""
    L, R, out_cols, rtypes = sides(left, right, left_hour, right_ts, right_cols, prefix, rename, left_flag, right_flag)
    if strategy == "native":
        return L.join(R, F.expr("_lh = _rh"), "full_outer").selectExpr(*out_cols)

    matched_or_right = R.join(L, F.expr("_rh = _lh"), "left")
    right_hours = R.selectExpr("_rh AS _dh").where("_dh IS NOT NULL").distinct()
    left_only = L.join(right_hours, F.expr("_lh = _dh"), "left_anti").selectExpr(
        *[_q(c) for c in L.columns], *[f"CAST(NULL AS {kind}) AS {_q(c)}" for c, kind in rtypes.items()]
    )
    return matched_or_right.selectExpr(*out_cols).unionByName(left_only.selectExpr(*out_cols))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sides(
    left: DataFrame,
    right: DataFrame,
    left_hour: str,
    right_ts: str,
    right_cols: Sequence[str] | None,
    prefix: str,
    rename: dict[str, str] | None,
    left_flag: str,
    right_flag: str,
) -> tuple[DataFrame, DataFrame, list[str], dict[str, str]]:
    """The two inputs with their hours as ``_lh`` and ``_rh``, the SQL of the
    output columns, and the types of the right input's columns."""
    rename = dict(rename or {})
    lcols = [c for c in left.columns if c != left_hour]
    rcols = [c for c in (right_cols or right.columns) if c != right_ts]
    rnames = {c: rename.get(c, prefix + c if c in lcols or c == left_hour else c) for c in rcols}
    # wide projections as SQL text: one JVM call each, same plan
    L = left.selectExpr(f"{_q(left_hour)} AS _lh", *[_q(c) for c in lcols])
    R = right.selectExpr(
        f"CAST(date_trunc('HOUR', {_q(right_ts)}) AS TIMESTAMP_NTZ) AS _rh",
        f"{_q(right_ts)} AS _rts",
        *[f"{_q(c)} AS {_q(rnames[c])}" for c in rcols],
    )
    out_cols = [
        "coalesce(_lh, _rh) AS hour",
        *[_q(c) for c in lcols],
        *[_q(rnames[c]) for c in rcols],
        f"_lh IS NOT NULL AS {_q(left_flag)}",
        f"_rts IS NOT NULL AS {_q(right_flag)}",
    ]
    return L, R, out_cols, {f.name: f.dataType.simpleString() for f in R.schema.fields}
