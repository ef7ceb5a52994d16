"""Registered queries for landed reading pages (S12), the wall-clock dashboard
variants (M20) and rows of cells (F10), over what Spark derives from the
driver's tables:

* a readings page per hour of ``events``: the page's markup is written around
  the hour's values, then read back as a landed page would be;
* rows of cells from ``lineitem``, whose header lists differ from row to row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.functions import trunc_ntz
from ampere.operators.reshape import cells_to_long
from ampere.plans import dashboard
from ampere.plans.catalog import ASOF_WALL, URGENT, register, t
from ampere.plans.catalog_marts import Q_FCT_GEN, Q_FCT_INT, Q_STG_RATES, _FUELS6, fct_gen, fct_int, stg_rate
from ampere.plans.catalog import q_exact_avg
from ampere.schemas import READING_MEASURES, READING_SOURCES
from ampere.sources.readings_page import FLOW_NAMES, TOTALS, readings_from_pages

#: The day the pages count as landed, after the last hour of the events.
LANDED = dt.date(2024, 12, 31)
#: A page's value of an hour: the hour's sum of one event type, or its rows, in the page's writing.
_SOURCE_OF = {"nuclear": "click", "hydro": "view", "gas": "purchase", "wind": "signup", "solar": "error"}


def _hours(ev: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("event_type") == kind).alias(f"n_{kind}") for kind in _SOURCE_OF.values()]
    return ev.where("ts IS NOT NULL").groupBy(trunc_ntz("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"), *counts)


def _page(hours: DataFrame) -> Column:
    """The page of an hour: an unknown value is a dash, thousands have commas."""

    def box(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'<div class="v"><b><span bind="{name}"></span></b>'), text, F.lit("</div>\n"))

    def total(label: str, text: Column) -> Column:
        return F.concat(F.lit(f"<div><p>{label}</p><br></div> <div>"), text, F.lit("</div>"))

    count = lambda c: F.format_number(F.col(c) * 1000, 0)
    h = F.hour("hour")
    label = F.concat(
        F.date_format("hour", "EEE MMM"), F.lit("  "), F.dayofmonth("hour").cast("string"), F.lit(", "),
        F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12).cast("string"), F.when(h < 12, F.lit(" AM")).otherwise(F.lit(" PM")), F.lit(" - next"),
    )
    parts = [F.lit("<!DOCTYPE html><html><body><!-- <div>no</div> -->"), box("timeOfReading", label)]
    for name, value in zip(FLOW_NAMES, (count("n_click"), count("n_view"), F.lit("&mdash;"))):
        parts.append(box(name, F.concat(value, F.lit("&nbsp;MW"))))
    for (name, (_, unit)), value in zip(TOTALS.items(), (count("n"), count("n_error"), F.lit("n/a"), F.col("n").cast("string"))):
        parts.append(total(name, F.concat(value, F.lit(f" {unit}"))))
    for source in READING_SOURCES:
        kind = _SOURCE_OF.get(source)
        parts.append(box(f"{source}Output", F.concat(count(f"n_{kind}"), F.lit(" MW")) if kind else F.lit("")))
        parts.append(box(f"{source}Percentage", F.concat(F.col(f"n_{kind}").cast("string"), F.lit(".5%")) if kind else F.lit("updating")))
    return F.concat(*parts, F.lit("</body></html>"))


def _q_readings_page() -> str:
    n = {s: f"count(*) FILTER (WHERE event_type = '{k}')" for s, k in _SOURCE_OF.items()}
    value = {c: "CAST(NULL AS DOUBLE)" for c in READING_MEASURES}
    value |= {"imports_mw": f"1000.0 * {n['nuclear']}", "exports_mw": f"1000.0 * {n['hydro']}", "power_generated_mw": "1000.0 * count(*)"}
    value |= {"ontario_demand_mw": f"1000.0 * {n['solar']}", "co2e_intensity_gco2_per_kwh": "count(*)"}
    for s in _SOURCE_OF:
        value |= {f"{s}_mw": f"1000.0 * {n[s]}", f"{s}_pct": f"{n[s]} + 0.5"}
    cols = ", ".join(f"CAST({value[c]} AS DOUBLE) AS {c}" for c in READING_MEASURES)
    return f"SELECT date_trunc('hour', ts) AS timestamp, {cols} FROM events WHERE ts IS NOT NULL GROUP BY 1"


@register("readings_page", _q_readings_page())
def readings_page(spark: SparkSession, d: str) -> DataFrame:
    hours = _hours(t(spark, d, "events"))
    return readings_from_pages(hours.select(_page(hours).alias("html")), LANDED)


# ── M20: the same reports on the wall clock, and a shorter history ───────────

TRAIL_DAYS = 7
_SINCE = f"TIMESTAMP '{ASOF_WALL}' - INTERVAL {TRAIL_DAYS} DAY"


@register(
    "dash_co2trend_asof",
    f"""WITH f AS ({Q_FCT_INT})
SELECT hour, co2e_intensity_gco2_per_kwh AS co2 FROM f WHERE hour >= {_SINCE} AND co2e_intensity_gco2_per_kwh IS NOT NULL""",
)
def dash_co2trend_asof(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.co2trend(fct_int(spark, d), days=TRAIL_DAYS, anchor=ASOF_WALL)


@register(
    "dash_monthly_asof",
    f"""WITH f AS ({Q_FCT_GEN})
SELECT CAST(hour AS DATE) AS day, {", ".join(f"{q_exact_avg(f'{x}_mw')} AS {x}" for x in _FUELS6)} FROM f WHERE hour >= {_SINCE} GROUP BY 1""",
)
def dash_monthly_asof(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.monthly(fct_gen(spark, d), days=TRAIL_DAYS, anchor=ASOF_WALL, exact_scale=2)


@register(
    "dash_rate_history_60",
    f"""WITH s AS ({Q_STG_RATES})
SELECT effective_date, rate_column, value_cents_per_kwh FROM s WHERE rate_type = '{URGENT}'
ORDER BY effective_date DESC NULLS LAST, rate_column ASC LIMIT 60""",
)
def dash_rate_history_60(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.rate_history(stg_rate(spark, d), URGENT, 60)


# ── F10 ──────────────────────────────────────────────────────────────────────


@register(
    "cells_to_long",
    """
WITH r AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber % 2 = 0 THEN ['flag', 'status'] ELSE ['status', 'flag', 'none'] END AS headers,
    CASE WHEN l_linenumber % 2 = 0 THEN [l_returnflag, l_linestatus, 'beyond'] ELSE [l_linestatus, l_returnflag] END AS cells
  FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber, headers, cells, unnest(range(least(len(headers), len(cells)))) AS i FROM r)
SELECT l_orderkey, l_linenumber, headers[i + 1] AS "column", cells[i + 1] AS value FROM u""",
)
def cells_to_long_q(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "IF(l_linenumber % 2 = 0, array('flag', 'status'), array('status', 'flag', 'none')) AS headers",
        "IF(l_linenumber % 2 = 0, array(l_returnflag, l_linestatus, 'beyond'), array(l_linestatus, l_returnflag)) AS cells",
    )
    return cells_to_long(rows, "headers", "cells")
