"""Stored table schemas and the table spec consumed by load functions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

D = T.DoubleType()
S = T.StringType()
NTZ = T.TimestampNTZType()

# Fuel classes of the generation tables, in table order.
FUELS = ["nuclear", "gas", "hydro", "wind", "solar", "biofuel", "other"]
# Fuel columns present in the monthly fuel-mix CSV (no `other`).
CSV_FUELS = ["nuclear", "gas", "hydro", "wind", "solar", "biofuel", "total"]
# Sources reported per fuel by the live readings page.
READING_SOURCES = ["nuclear", "hydro", "gas", "wind", "biofuel", "solar"]
# The 19 measure columns of the readings tables.
READING_MEASURES = [
    "imports_mw",
    "exports_mw",
    "net_import_exports_mw",
    "power_generated_mw",
    "ontario_demand_mw",
    "total_emissions_tonnes",
    "co2e_intensity_gco2_per_kwh",
    "nuclear_mw",
    "nuclear_pct",
    "hydro_mw",
    "hydro_pct",
    "gas_mw",
    "gas_pct",
    "wind_mw",
    "wind_pct",
    "biofuel_mw",
    "biofuel_pct",
    "solar_mw",
    "solar_pct",
]

GENERATION_RAW = T.StructType(
    [T.StructField("timestamp", NTZ)] + [T.StructField(f, D) for f in FUELS + ["total"]]
)
READINGS_RAW = T.StructType(
    [T.StructField("timestamp", NTZ)] + [T.StructField(c, D) for c in READING_MEASURES]
)
RATES_RAW = T.StructType(
    [
        T.StructField("effective_date", T.DateType()),
        T.StructField("rate_type", S),
        T.StructField("rate_column", S),
        T.StructField("value_cents_per_kwh", D),
    ]
)
STG_GENERATION = T.StructType(
    [T.StructField("ts", NTZ)] + [T.StructField(f"{f}_mw", D) for f in FUELS + ["total"]]
)
STG_READINGS = T.StructType(
    [T.StructField("ts", NTZ)] + [T.StructField(c, D) for c in READING_MEASURES]
)
STG_RATES = RATES_RAW
RUN_LOG = T.StructType(
    [
        T.StructField("run_id", S),
        T.StructField("timestamp", NTZ),
        T.StructField("source", S),
        T.StructField("status", S),
        T.StructField("error_message", S),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("duration_seconds", D),
        T.StructField("git_commit", S),
        T.StructField("github_run_id", S),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: name, schema, key columns, write mode and cursor column."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    mode: str = "merge"  # merge | replace | insert_absent
    cursor: str | None = None
    partition_by: tuple[str, ...] = field(default_factory=tuple)
    source_tz: str | None = None


GENERATION_SPEC = TableSpec("generation", GENERATION_RAW, ("timestamp",), cursor="timestamp")
READINGS_SPEC = TableSpec("readings", READINGS_RAW, ("timestamp",), cursor="timestamp")
RATES_SPEC = TableSpec(
    "rates", RATES_RAW, ("effective_date", "rate_type", "rate_column"), cursor="effective_date"
)


# Declared schemas of the input tables the registered queries read. A declared
# schema is the contract for the scan (a retyped column fails loudly) and
# spares the driver the footer read of schema inference on every open.
INPUT_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "pages": "page_id bigint, url string, html string",
}
