from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_non_null(df: DataFrame, cols: list[str], what: str = "key") -> DataFrame:
    """Fail the query at run time if any of ``cols`` is NULL (no extra job)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    msg = F.lit(f"NULL {what} in columns {cols}")
    return df.filter(F.when(cond, F.raise_error(msg)).otherwise(F.lit(True)))
