"""Registered queries that run the composite plans users run — staging
(M1–M3), the two marts (M4, M5) and the dashboard reports (M9–M19) — on raw
tables Spark derives from the driver's tables:

* generation raw: ``events`` pivoted per hour into fuel columns (click →
  nuclear, purchase → gas, view → hydro, signup → wind, error → solar;
  biofuel and other absent), history = hours before Jan 20, live = hours
  from Jan 10 with every value + 1 (so live must win the overlap);
* readings raw: ``error`` events (intensity = value, demand = user id),
  history before Jan 20, live from Jan 10 with value + 1;
* rates raw: ``orders`` (date, priority as rate type, status as rate column,
  total price as value), history = all, live = from 2001 with price + 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.functions import trunc_ntz
from ampere.functions.numeric import exact_sum_sql
from ampere.operators import reports
from ampere.plans import dashboard, marts, staging
from ampere.plans.catalog import URGENT, q_exact_avg, q_exact_sum, q_round, register, t, ts_lit
from ampere.schemas import FUELS, READING_MEASURES

# Event type standing in for each fuel.
FUEL_OF_TYPE = {"nuclear": "click", "gas": "purchase", "hydro": "view", "wind": "signup", "solar": "error"}
HIST_BEFORE = "2024-01-20 00:00:00"
LIVE_FROM = "2024-01-10 00:00:00"
RATES_LIVE_FROM = "2001-01-01 00:00:00"
TRAIL_DAYS = 7


# ── derived raw tables ───────────────────────────────────────────────────────


def gen_raw(ev: DataFrame, bump: float) -> DataFrame:
    v = f"(value + {bump!r}D)"
    aggs = [F.expr(f"{exact_sum_sql(f'CASE WHEN event_type = {chr(39)}{e}{chr(39)} THEN {v} END')} AS {f}") for f, e in FUEL_OF_TYPE.items()]
    g = ev.groupBy(trunc_ntz("hour", "ts").alias("timestamp")).agg(*aggs, F.expr(f"{exact_sum_sql(v)} AS total"))
    return g.selectExpr("timestamp", *[f if f in FUEL_OF_TYPE else f"CAST(NULL AS DOUBLE) AS {f}" for f in FUELS], "total")


def _q_gen_raw(where: str, bump: str) -> str:
    cols = []
    for f in FUELS:
        if f in FUEL_OF_TYPE:
            cols.append(f"{q_exact_sum(f'CASE WHEN event_type = {chr(39)}{FUEL_OF_TYPE[f]}{chr(39)} THEN value{bump} END')} AS {f}")
        else:
            cols.append(f"CAST(NULL AS DOUBLE) AS {f}")
    return (
        f"SELECT date_trunc('hour', ts) AS timestamp, {', '.join(cols)}, {q_exact_sum(f'value{bump}')} AS total "
        f"FROM events WHERE {where} GROUP BY 1"
    )


def readings_raw(ev: DataFrame, bump: float) -> DataFrame:
    e = ev.where("event_type = 'error'")
    vals = {
        "co2e_intensity_gco2_per_kwh": f"value + {bump!r}D",
        "ontario_demand_mw": "CAST(user_id AS DOUBLE)",
        "nuclear_mw": f"value + {bump!r}D",
    }
    return e.selectExpr("ts AS timestamp", *[f"{vals.get(c, 'CAST(NULL AS DOUBLE)')} AS {c}" for c in READING_MEASURES])


def _q_readings_raw(where: str, bump: str) -> str:
    vals = {
        "co2e_intensity_gco2_per_kwh": f"value{bump}",
        "ontario_demand_mw": "CAST(user_id AS DOUBLE)",
        "nuclear_mw": f"value{bump}",
    }
    cols = ", ".join(f"{vals.get(c, 'CAST(NULL AS DOUBLE)')} AS {c}" for c in READING_MEASURES)
    return f"SELECT ts AS timestamp, {cols} FROM events WHERE event_type = 'error' AND {where}"


def rates_raw(o: DataFrame, bump: float) -> DataFrame:
    return o.select(
        F.col("o_orderdate").cast("date").alias("effective_date"),
        F.col("o_orderpriority").alias("rate_type"),
        F.col("o_orderstatus").alias("rate_column"),
        (F.col("o_totalprice") + F.lit(bump)).alias("value_cents_per_kwh"),
    )


def _q_rates_raw(where: str, bump: str) -> str:
    return (
        "SELECT CAST(o_orderdate AS DATE) AS effective_date, o_orderpriority AS rate_type, "
        f"o_orderstatus AS rate_column, o_totalprice{bump} AS value_cents_per_kwh FROM orders WHERE {where}"
    )


# ── Spark side: the real plans over the derived tables ───────────────────────


def stg_gen(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    hist = gen_raw(ev.filter(F.col("ts") < ts_lit(HIST_BEFORE)), 0.0)
    live = gen_raw(ev.filter(F.col("ts") >= ts_lit(LIVE_FROM)), 1.0)
    return staging.stg_generation(spark, hist, live)


def stg_read(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    hist = readings_raw(ev.filter(F.col("ts") < ts_lit(HIST_BEFORE)), 0.0)
    live = readings_raw(ev.filter(F.col("ts") >= ts_lit(LIVE_FROM)), 1.0)
    return staging.stg_readings(spark, hist, live)


def stg_rate(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders")
    return staging.stg_rates(spark, rates_raw(o, 0.0), rates_raw(o.filter(F.col("o_orderdate") >= ts_lit(RATES_LIVE_FROM)), 1.0))


def fct_gen(spark: SparkSession, d: str) -> DataFrame:
    return marts.fct_generation(stg_gen(spark, d))


def fct_int(spark: SparkSession, d: str) -> DataFrame:
    return marts.fct_intensity(fct_gen(spark, d), stg_read(spark, d))


# ── oracle side ──────────────────────────────────────────────────────────────

_GEN_COLS = [f"{f}_mw" for f in FUELS + ["total"]]
Q_STG_GEN = f"""
WITH u AS (
  SELECT timestamp AS ts, {", ".join(f"coalesce({f}, CAST(0 AS DOUBLE)) AS {f}_mw" for f in FUELS + ["total"])}, 0 AS p
  FROM ({_q_gen_raw(f"ts < TIMESTAMP '{HIST_BEFORE}'", "")})
  UNION ALL
  SELECT timestamp AS ts, {", ".join(f"coalesce({f}, CAST(0 AS DOUBLE)) AS {f}_mw" for f in FUELS + ["total"])}, 1 AS p
  FROM ({_q_gen_raw(f"ts >= TIMESTAMP '{LIVE_FROM}'", " + 1")}))
SELECT ts, {", ".join(_GEN_COLS)} FROM u
QUALIFY row_number() OVER (PARTITION BY ts ORDER BY p DESC, {", ".join(f"{c} DESC NULLS LAST" for c in _GEN_COLS)}) = 1"""

Q_STG_READ = f"""
WITH u AS (
  SELECT timestamp AS ts, {", ".join(READING_MEASURES)}, 0 AS p FROM ({_q_readings_raw(f"ts < TIMESTAMP '{HIST_BEFORE}'", "")})
  UNION ALL
  SELECT timestamp AS ts, {", ".join(READING_MEASURES)}, 1 AS p FROM ({_q_readings_raw(f"ts >= TIMESTAMP '{LIVE_FROM}'", " + 1")}))
SELECT ts, {", ".join(READING_MEASURES)} FROM u
QUALIFY row_number() OVER (PARTITION BY ts ORDER BY p DESC, {", ".join(f"{c} DESC NULLS LAST" for c in READING_MEASURES)}) = 1"""

Q_STG_RATES = f"""
WITH u AS (
  SELECT *, 0 AS p FROM ({_q_rates_raw("TRUE", "")})
  UNION ALL
  SELECT *, 1 AS p FROM ({_q_rates_raw(f"o_orderdate >= TIMESTAMP '{RATES_LIVE_FROM}'", " + 1")}))
SELECT effective_date, rate_type, rate_column, value_cents_per_kwh FROM u
QUALIFY row_number() OVER (PARTITION BY effective_date, rate_type, rate_column
                           ORDER BY p DESC, value_cents_per_kwh DESC NULLS LAST) = 1"""

Q_FCT_GEN = f"""
WITH s AS ({Q_STG_GEN})
SELECT date_trunc('hour', ts) AS hour, date_trunc('day', ts) AS day, date_trunc('month', ts) AS month,
  nuclear_mw, gas_mw, hydro_mw, wind_mw, solar_mw, biofuel_mw, total_mw,
  {q_round("100.0 * ((((nuclear_mw + hydro_mw) + wind_mw) + solar_mw) + biofuel_mw) / nullif(total_mw, 0)", 1)} AS clean_pct
FROM s"""

_GW = [f"{s}_{k}" for s in ["nuclear", "hydro", "gas", "wind", "biofuel", "solar"] for k in ("mw", "pct")]
Q_FCT_INT = f"""
WITH g AS ({Q_FCT_GEN}), gw AS ({Q_STG_READ})
SELECT coalesce(g.hour, date_trunc('hour', gw.ts)) AS hour,
  g.nuclear_mw, g.gas_mw, g.hydro_mw, g.wind_mw, g.solar_mw, g.biofuel_mw, g.total_mw, g.clean_pct,
  gw.ontario_demand_mw, gw.imports_mw, gw.exports_mw, gw.net_import_exports_mw, gw.total_emissions_tonnes,
  gw.co2e_intensity_gco2_per_kwh,
  {", ".join(f"gw.{c} AS gw_{c}" for c in _GW)},
  g.hour IS NOT NULL AS has_generation, gw.ts IS NOT NULL AS has_readings
FROM g FULL OUTER JOIN gw ON date_trunc('hour', gw.ts) = g.hour"""

_FUELS6 = ["nuclear", "hydro", "wind", "solar", "biofuel", "gas"]


# ── registrations ────────────────────────────────────────────────────────────


@register("stg_generation", Q_STG_GEN)
def q_stg_generation(spark: SparkSession, d: str) -> DataFrame:
    return stg_gen(spark, d)


@register("stg_readings", Q_STG_READ)
def q_stg_readings(spark: SparkSession, d: str) -> DataFrame:
    return stg_read(spark, d)


@register("stg_rates", Q_STG_RATES)
def q_stg_rates(spark: SparkSession, d: str) -> DataFrame:
    return stg_rate(spark, d)


@register("fct_generation_mart", Q_FCT_GEN)
def q_fct_generation_mart(spark: SparkSession, d: str) -> DataFrame:
    return fct_gen(spark, d)


@register("fct_intensity", Q_FCT_INT)
def q_fct_intensity(spark: SparkSession, d: str) -> DataFrame:
    return fct_int(spark, d)


@register(
    "dash_latest",
    f"""WITH f AS ({Q_FCT_INT})
SELECT hour, total_mw, clean_pct, co2e_intensity_gco2_per_kwh FROM f
ORDER BY hour DESC NULLS LAST, total_mw DESC NULLS LAST, clean_pct DESC NULLS LAST,
         co2e_intensity_gco2_per_kwh DESC NULLS LAST LIMIT 1""",
)
def q_dash_latest(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.latest(fct_int(spark, d))


@register(
    "dash_generation",
    f"""WITH f AS ({Q_FCT_GEN})
SELECT hour, {", ".join(f"{x}_mw" for x in _FUELS6)}, total_mw, clean_pct FROM f ORDER BY hour DESC NULLS LAST LIMIT 8760""",
)
def q_dash_generation(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.generation(fct_gen(spark, d))


@register(
    "dash_monthly",
    f"""WITH f AS ({Q_FCT_GEN})
SELECT CAST(hour AS DATE) AS day, {", ".join(f"{q_exact_avg(f'{x}_mw')} AS {x}" for x in _FUELS6)} FROM f
WHERE hour >= (SELECT max(hour) FROM f) - INTERVAL {TRAIL_DAYS} DAY GROUP BY 1""",
)
def q_dash_monthly(spark: SparkSession, d: str) -> DataFrame:
    # the mart's hours are the hours of the events it is built from, so its
    # max(hour) is date_trunc('hour', max(ts)) of the events: a one-column scan
    # instead of a second build of the mart inside the scalar subquery
    anchor = reports.hour_anchor(t(spark, d, "events"), "ts")
    return dashboard.monthly(fct_gen(spark, d), days=TRAIL_DAYS, anchor=anchor, exact_scale=2)


@register(
    "dash_co2trend",
    f"""WITH f AS ({Q_FCT_INT})
SELECT hour, co2e_intensity_gco2_per_kwh AS co2 FROM f
WHERE hour >= (SELECT max(hour) FROM f) - INTERVAL {TRAIL_DAYS} DAY AND co2e_intensity_gco2_per_kwh IS NOT NULL""",
)
def q_dash_co2trend(spark: SparkSession, d: str) -> DataFrame:
    # both sides of the wide fact take their hours from events (see q_dash_monthly)
    anchor = reports.hour_anchor(t(spark, d, "events"), "ts")
    return dashboard.co2trend(fct_int(spark, d), days=TRAIL_DAYS, anchor=anchor)


def _q_avg_report(key_expr: str, key: str, names: dict[str, str]) -> str:
    cols = ", ".join(f"{q_round(q_exact_avg(f'{x}_mw'), 0)} AS {names[x]}" for x in _FUELS6 + ["total"])
    return f"""WITH f AS ({Q_FCT_GEN})
SELECT {key_expr} AS {key}, {cols}, {q_round(f"{q_exact_avg('clean_pct')} / 100.0", 3)} AS avg_clean_pct
FROM f GROUP BY 1"""


@register("dash_full_history", _q_avg_report("date_trunc('month', hour)", "month", {x: f"avg_{x}" for x in _FUELS6 + ["total"]}))
def q_dash_full_history(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.generation_full_history(fct_gen(spark, d), exact_scale=2)


@register("dash_annual", _q_avg_report("year(hour)", "year", {x: f"avg_{x}_mw" for x in _FUELS6 + ["total"]}))
def q_dash_annual(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.generation_annual(fct_gen(spark, d), exact_scale=2)


@register(
    "dash_co2_history",
    f"""WITH f AS ({Q_FCT_INT})
SELECT date_trunc('month', hour) AS month,
  {q_round(q_exact_avg('co2e_intensity_gco2_per_kwh'), 1)} AS avg_co2_intensity,
  {q_round('min(co2e_intensity_gco2_per_kwh)', 1)} AS min_co2_intensity,
  {q_round('max(co2e_intensity_gco2_per_kwh)', 1)} AS max_co2_intensity
FROM f WHERE co2e_intensity_gco2_per_kwh IS NOT NULL GROUP BY 1""",
)
def q_dash_co2_history(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.co2_full_history(fct_int(spark, d))


@register(
    "dash_rate_history",
    f"""WITH s AS ({Q_STG_RATES})
SELECT effective_date, rate_column, value_cents_per_kwh FROM s WHERE rate_type = '{URGENT}'
ORDER BY effective_date DESC NULLS LAST, rate_column ASC LIMIT 90""",
)
def q_dash_rate_history(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.rate_history(stg_rate(spark, d), URGENT, 90)


@register(
    "dash_current_rates",
    f"""WITH s AS ({Q_STG_RATES})
SELECT rate_column, value_cents_per_kwh FROM s
WHERE rate_type = '{URGENT}' AND effective_date = (SELECT max(effective_date) FROM s WHERE rate_type = '{URGENT}')""",
)
def q_dash_current_rates(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.current_rates(stg_rate(spark, d), URGENT)
