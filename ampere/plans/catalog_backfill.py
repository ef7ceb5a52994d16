"""Registered queries that run the historical backfills (M6–M8) end to end on
frames derived from the driver's tables, each ending in insert-if-absent.

* M6: ``events`` as a plant-level wide file (one plant column per event type,
  ``error`` as the reported total), offset-bearing timestamps;
* M7: ``error`` events as a readings file with its own headers and a junk column;
* M8: ``orders`` as parsed rate tables (headers and cells per order).

Stored rows are those before ``STORED_BEFORE``, with values one higher, so
that they must win over the backfill.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.operators.keyed import insert_absent
from ampere.plans.backfill import generation_history, rates_from_tables, readings_history
from ampere.plans.catalog import register, t
from ampere.schemas import FUELS, RATES_RAW
from ampere.session import checkpoint_dir

STORED_BEFORE = "2024-01-20 00:00:00"
RATES_STORED_BEFORE = "1995-01-01"
# Event type → plant column, and the fuel the plant's name stands for.
PLANTS = {"click": ("PICKERING G1", "nuclear"), "view": ("BECK 2", "hydro"), "purchase": ("MYSTERY 9", "other"), "signup": ("NEW PLANT X", "wind")}

#: An event's second as a UTC-5 label, which the backfill turns into UTC.
STAMP = "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '-05:00') AS timestamp"
_FIRST = "row_number() OVER (PARTITION BY date_trunc('second', ts) ORDER BY event_id) = 1"


def _q_generation() -> str:
    of = {fuel: kind for kind, (_, fuel) in PLANTS.items()}
    cols = [f"CASE WHEN event_type = '{of[f]}' THEN coalesce(value, 0.0) ELSE 0.0 END AS {f}" if f in of else f"CAST(0 AS DOUBLE) AS {f}" for f in FUELS]
    return f"""
WITH f AS (SELECT date_trunc('second', ts) + INTERVAL 5 HOUR AS timestamp, {", ".join(cols)}, coalesce(value, 0.0) AS total
           FROM events WHERE ts IS NOT NULL QUALIFY {_FIRST})
SELECT timestamp, {", ".join(FUELS)}, total + CASE WHEN timestamp < TIMESTAMP '{STORED_BEFORE}' THEN 1 ELSE 0 END AS total FROM f"""


@register("generation_backfill", _q_generation())
def generation_backfill(spark: SparkSession, d: str) -> DataFrame:
    plants = [f"CASE WHEN event_type = '{kind}' THEN CAST(value AS STRING) END AS `{name}`" for kind, (name, _) in PLANTS.items()]
    total = "CASE WHEN event_type = 'error' THEN CAST(value AS STRING) END AS TOTAL"
    wide = t(spark, d, "events").where("ts IS NOT NULL").selectExpr(STAMP, *plants, total, "event_id AS _row")
    mapping = spark.createDataFrame([("NEW PLANT X", "wind")], "_mkey string, _mclass string")
    hist = generation_history(wide, mapping)
    stored = hist.where(F.col("timestamp") < F.lit(STORED_BEFORE).cast("timestamp_ntz")).withColumn("total", F.col("total") + 1.0)
    return insert_absent(stored, hist, ["timestamp"])


@register(
    "readings_backfill",
    f"""
WITH f AS (SELECT date_trunc('second', ts) + INTERVAL 5 HOUR AS timestamp, value AS nuclear_mw, CAST(user_id AS DOUBLE) AS imports_mw
           FROM events WHERE ts IS NOT NULL AND event_type = 'error' QUALIFY {_FIRST})
SELECT timestamp, nuclear_mw + CASE WHEN timestamp < TIMESTAMP '{STORED_BEFORE}' THEN 1 ELSE 0 END AS nuclear_mw, imports_mw FROM f""",
)
def readings_backfill(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events").where("ts IS NOT NULL AND event_type = 'error'")
    wide = ev.selectExpr(STAMP, "CAST(value AS STRING) AS `nuclear (MW)`", "CAST(user_id AS STRING) AS `Imports (MW)`", "props AS junk", "event_id AS _row")
    hist = readings_history(wide)
    stored = hist.where(F.col("timestamp") < F.lit(STORED_BEFORE).cast("timestamp_ntz")).withColumn("nuclear_mw", F.col("nuclear_mw") + 1.0)
    return insert_absent(stored, hist, ["timestamp"])


@register(
    "rates_backfill",
    f"""
SELECT CAST(o_orderdate AS DATE) AS effective_date, o_orderpriority AS rate_type, 'Order ' || o_orderkey AS rate_column,
  o_totalprice + CASE WHEN o_orderdate < DATE '{RATES_STORED_BEFORE}' THEN 1 ELSE 0 END AS value_cents_per_kwh
FROM orders""",
)
def rates_backfill(spark: SparkSession, d: str) -> DataFrame:
    tables = t(spark, d, "orders").selectExpr(
        "o_orderkey AS page_id", "0 AS table_pos", "0 AS row_pos", "o_orderpriority AS rate_type",
        "array('Effective date', concat('Order ', o_orderkey)) AS headers",
        "array(date_format(o_orderdate, 'MMMM d, yyyy'), concat(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), ' ¢ per kWh')) AS cells",
    )
    # parsed once, for the stored rows and for the batch
    path = f"{checkpoint_dir(spark)}/rates-{uuid.uuid4().hex}"
    rates_from_tables(tables).write.parquet(path)
    rates = spark.read.schema(RATES_RAW).parquet(path)
    stored = rates.where(F.col("effective_date") < F.lit(RATES_STORED_BEFORE).cast("date"))
    stored = stored.withColumn("value_cents_per_kwh", F.col("value_cents_per_kwh") + 1.0)
    return insert_absent(stored, rates, ["effective_date", "rate_type", "rate_column"])
