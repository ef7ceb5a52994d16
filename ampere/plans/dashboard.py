"""Dashboard report queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.functions.numeric import exact_avg_sql, round_half_away_sql
from ampere.operators import reports

FUELS6 = ["nuclear", "hydro", "wind", "solar", "biofuel", "gas"]
# Rate categories used by the dashboard pages.
TOU = "Time-of-Use (TOU) rates"
TIERED = "Tiered rates"
ULO = "Ultra-Low Overnight (ULO)"


def latest(fct_int: DataFrame) -> DataFrame:
    """M9: the newest hour with total, share and intensity (rows sharing the
    newest hour are ordered by the remaining columns, so the pick is stable)."""
    cols = ["hour", "total_mw", "clean_pct", "co2e_intensity_gco2_per_kwh"]
    return reports.newest_n(fct_int.select(*cols), [F.col(c).desc_nulls_last() for c in cols], 1)


def generation(fct_gen: DataFrame, n: int = 8760) -> DataFrame:
    """Newest ``n`` hours."""
    cols = ["hour", *[f"{f}_mw" for f in FUELS6], "total_mw", "clean_pct"]
    return reports.newest_n(fct_gen.select(*cols), [F.col("hour").desc_nulls_last()], n)


def monthly(fct_gen: DataFrame, days: int = 30, anchor=None, exact_scale: int | None = None) -> DataFrame:
    """Daily averages over the trailing ``days`` (anchored on the
    data's max hour, or on ``anchor``). ``exact_scale`` averages values with
    that many decimals exactly (order-independent) instead of in floating point."""
    t = reports.trailing(fct_gen, "hour", days, anchor)
    return reports.avg_by(t, "date", "hour", {f: f"{f}_mw" for f in FUELS6}, exact_scale=exact_scale, out_key="day").orderBy("day")


def co2trend(fct_int: DataFrame, days: int = 30, anchor=None) -> DataFrame:
    """Hourly intensity over the trailing window, NULLs dropped."""
    t = reports.trailing(fct_int, "hour", days, anchor)
    return (
        t.filter(F.col("co2e_intensity_gco2_per_kwh").isNotNull())
        .select("hour", F.col("co2e_intensity_gco2_per_kwh").alias("co2"))
        .orderBy("hour")
    )


def _avg(c: str, exact_scale: int | None) -> str:
    return exact_avg_sql(c, exact_scale) if exact_scale is not None else f"avg({c})"


def _avg_report(fct_gen: DataFrame, grain: str, names: dict[str, str], exact_scale: int | None) -> DataFrame:
    key = "year" if grain == "year" else "month"
    aggs = [F.expr(f"{round_half_away_sql(_avg(f'{f}_mw', exact_scale), 0)} AS {names[f]}") for f in FUELS6 + ["total"]]
    aggs.append(F.expr(f"{round_half_away_sql(_avg('clean_pct', exact_scale) + ' / 100.0D', 3)} AS avg_clean_pct"))
    return fct_gen.groupBy(reports.bucket(grain, "hour").alias(key)).agg(*aggs).orderBy(key)


def generation_full_history(fct_gen: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Monthly rounded averages + share."""
    return _avg_report(fct_gen, "month", {f: f"avg_{f}" for f in FUELS6 + ["total"]}, exact_scale)


def generation_annual(fct_gen: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Annual rounded averages + share."""
    return _avg_report(fct_gen, "year", {f: f"avg_{f}_mw" for f in FUELS6 + ["total"]}, exact_scale)


def co2_full_history(fct_int: DataFrame) -> DataFrame:
    """Monthly avg/min/max intensity, NULLs excluded."""
    return reports.stats_by(fct_int, "month", "hour", "co2e_intensity_gco2_per_kwh", "co2_intensity", 1).orderBy("month")


def rate_history(stg_rates: DataFrame, rate_type: str = TOU, n: int = 90) -> DataFrame:
    """Newest ``n`` rows of one rate type; ties at the cut broken by
    the rate column name (the source leaves them arbitrary)."""
    d = stg_rates.filter(F.col("rate_type") == F.lit(rate_type)).select(
        "effective_date", "rate_column", "value_cents_per_kwh"
    )
    return reports.newest_n(d, [F.col("effective_date").desc_nulls_last(), F.col("rate_column").asc()], n)


def current_rates(stg_rates: DataFrame, rate_type: str = TOU) -> DataFrame:
    """One rate type at its latest date, dearest first."""
    d = reports.latest_for_category(stg_rates, "rate_type", rate_type, "effective_date")
    return d.select("rate_column", "value_cents_per_kwh").orderBy(
        F.col("value_cents_per_kwh").desc_nulls_last(), "rate_column"
    )
