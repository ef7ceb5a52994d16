"""Marts: hourly generation fact (M4) and the wide hourly fact joining it with
live readings (M5, the flagship), plus their materialisation (K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampere.functions.numeric import share_pct_sql
from ampere.operators.joins import hourly_full_outer
from ampere.plans import staging
from ampere.schemas import GENERATION_RAW, RATES_RAW, READINGS_RAW, READING_SOURCES
from ampere.sources.files import table_or_empty

# Zero-emission classes counted in clean_pct (other excluded).
CLEAN_FUELS = ["nuclear", "hydro", "wind", "solar", "biofuel"]
# Live reading columns carried into the wide fact, in order.
LIVE_COLS = [
    "ontario_demand_mw",
    "imports_mw",
    "exports_mw",
    "net_import_exports_mw",
    "total_emissions_tonnes",
    "co2e_intensity_gco2_per_kwh",
]


def fct_generation(stg: DataFrame) -> DataFrame:
    """hour/day/month + six fuels + total + clean_pct (`other_mw` dropped)."""
    fuels = ["nuclear", "gas", "hydro", "wind", "solar", "biofuel"]
    return stg.selectExpr(
        *[f"CAST(date_trunc('{u}', ts) AS TIMESTAMP_NTZ) AS {u.lower()}" for u in ("HOUR", "DAY", "MONTH")],
        *[f"{f}_mw" for f in fuels],
        "total_mw",
        f"{share_pct_sql([f'{f}_mw' for f in CLEAN_FUELS], 'total_mw', 1)} AS clean_pct",
    )


def fct_intensity(
    fct_gen: DataFrame,
    stg_read: DataFrame,
    strategy: str = "split",
    flags: tuple[str, str] = ("has_generation", "has_readings"),
) -> DataFrame:
    left = fct_gen.select(
        "hour", *[f"{f}_mw" for f in ["nuclear", "gas", "hydro", "wind", "solar", "biofuel"]], "total_mw", "clean_pct"
    )
    gw = []
    rename = {}
    for s in READING_SOURCES:
        for kind in ("mw", "pct"):
            c = f"{s}_{kind}"
            gw.append(c)
            rename[c] = f"gw_{c}"
    right = stg_read.select("ts", *LIVE_COLS, *gw)
    return hourly_full_outer(
        left,
        right,
        "hour",
        "ts",
        right_cols=[*LIVE_COLS, *gw],
        rename=rename,
        left_flag=flags[0],
        right_flag=flags[1],
        strategy=strategy,
    )


def build_marts(spark: SparkSession, raw_root: str, out_root: str | None = None) -> dict[str, DataFrame]:
    """Staging views + fact tables from the raw folder (K6). Staging stays lazy
    (temp views); facts are written once when ``out_root`` is given and then
    re-read, so every report scans the materialised files."""
    r = raw_root.rstrip("/")
    gen = staging.stg_generation(
        spark,
        table_or_empty(spark, f"{r}/generation_history", GENERATION_RAW),
        table_or_empty(spark, f"{r}/generation_live", GENERATION_RAW),
    )
    rd = staging.stg_readings(
        spark,
        table_or_empty(spark, f"{r}/readings_history", READINGS_RAW),
        table_or_empty(spark, f"{r}/readings_live", READINGS_RAW),
    )
    rates = staging.stg_rates(
        spark,
        table_or_empty(spark, f"{r}/rates_history", RATES_RAW),
        table_or_empty(spark, f"{r}/rates_live", RATES_RAW),
    )
    for name, df in (("stg_generation", gen), ("stg_readings", rd), ("stg_rates", rates)):
        df.createOrReplaceTempView(name)
    fg = fct_generation(gen)
    fi = fct_intensity(fg, rd)
    if out_root:
        o = out_root.rstrip("/")
        fg.write.mode("overwrite").parquet(f"{o}/fct_generation")
        fg = spark.read.parquet(f"{o}/fct_generation")
        # the hour join reads the staged readings twice (see hourly_full_outer):
        # stage them once as a table next to the marts, which also cuts lineage
        rd.write.mode("overwrite").parquet(f"{o}/_stg_readings")
        rd = spark.read.parquet(f"{o}/_stg_readings")
        fi = fct_intensity(fg, rd)
        fi.write.mode("overwrite").parquet(f"{o}/fct_intensity")
        fi = spark.read.parquet(f"{o}/fct_intensity")
    fg.createOrReplaceTempView("fct_generation")
    fi.createOrReplaceTempView("fct_intensity")
    return {"stg_generation": gen, "stg_readings": rd, "stg_rates": rates, "fct_generation": fg, "fct_intensity": fi}
