"""Staging: cast-and-rename each optional raw table, union history (priority
0) with live (priority 1), keep the highest priority per key (M1–M3).

A missing input is simply left out of the plan (the existence probe decides
the plan, S14); both missing gives a typed empty frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampere.operators.keyed import latest_by_priority
from ampere.schemas import FUELS, READING_MEASURES, STG_GENERATION, STG_RATES, STG_READINGS


def _ts_sql(source_tz: str | None) -> str:
    ts = "CAST(`timestamp` AS TIMESTAMP_NTZ)"
    if source_tz:
        ts = f"CAST(to_utc_timestamp({ts}, '{source_tz}') AS TIMESTAMP_NTZ)"
    return f"{ts} AS ts"


def stage_generation(df: DataFrame, source_tz: str | None = None) -> DataFrame:
    """P1 + P2: typed hour-start ``ts`` and ``<fuel>_mw`` with NULL → 0.
    (One SQL projection: cast-and-rename is the whole operator.)"""
    have = set(df.columns)
    cols = [
        f"coalesce(CAST({f if f in have else 'NULL'} AS DOUBLE), CAST(0 AS DOUBLE)) AS {f}_mw"
        for f in FUELS + ["total"]
    ]
    return df.selectExpr(_ts_sql(source_tz), *cols)


def stage_readings(df: DataFrame, source_tz: str | None = None) -> DataFrame:
    have = set(df.columns)
    cols = [f"CAST({c if c in have else 'NULL'} AS DOUBLE) AS {c}" for c in READING_MEASURES]
    return df.selectExpr(_ts_sql(source_tz), *cols)


def stage_rates(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "CAST(effective_date AS DATE) AS effective_date",
        "CAST(rate_type AS STRING) AS rate_type",
        "CAST(rate_column AS STRING) AS rate_column",
        "CAST(value_cents_per_kwh AS DOUBLE) AS value_cents_per_kwh",
    )


def stg_generation(
    spark: SparkSession, hist: DataFrame | None, live: DataFrame | None, source_tz: str | None = None
) -> DataFrame:
    if hist is None and live is None:
        return spark.createDataFrame([], STG_GENERATION)
    sides = [(stage_generation(d, source_tz) if d is not None else None, p) for d, p in ((hist, 0), (live, 1))]
    tiebreak = [f"{f}_mw DESC NULLS LAST" for f in FUELS + ["total"]]
    return latest_by_priority(*sides, keys=["ts"], tiebreak=tiebreak)


def stg_readings(
    spark: SparkSession, hist: DataFrame | None, live: DataFrame | None, source_tz: str | None = None
) -> DataFrame:
    if hist is None and live is None:
        return spark.createDataFrame([], STG_READINGS)
    sides = [(stage_readings(d, source_tz) if d is not None else None, p) for d, p in ((hist, 0), (live, 1))]
    tiebreak = [f"{c} DESC NULLS LAST" for c in READING_MEASURES]
    return latest_by_priority(*sides, keys=["ts"], tiebreak=tiebreak)


def stg_rates(spark: SparkSession, hist: DataFrame | None, live: DataFrame | None) -> DataFrame:
    if hist is None and live is None:
        return spark.createDataFrame([], STG_RATES)
    sides = [(stage_rates(d) if d is not None else None, p) for d, p in ((hist, 0), (live, 1))]
    return latest_by_priority(
        *sides,
        keys=["effective_date", "rate_type", "rate_column"],
        tiebreak=["value_cents_per_kwh DESC NULLS LAST"],
    )
