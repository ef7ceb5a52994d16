"""Historical backfills (M6, M7, rates history) and the rates page parse (M8).

Each backfill ends in ``insert_absent``: existing rows win, new keys are
appended by column name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.functions.numeric import parse_numeric
from ampere.functions.text import clean_cell, clean_header, conditional_fill, pad_array, seasonal_split
from ampere.functions.time import iso_seconds, to_utc_naive
from ampere.operators.keyed import dedupe_first
from ampere.operators.reshape import melt, plants_to_fuels
from ampere.schemas import FUELS
from ampere.sources.files import ROW
from ampere.sources.html import html_tables

# Historical readings header → stored column name.
READINGS_COLUMN_MAP = {
    "nuclear (MW)": "nuclear_mw",
    "hydro (MW)": "hydro_mw",
    "gas (MW)": "gas_mw",
    "wind (MW)": "wind_mw",
    "biofuel (MW)": "biofuel_mw",
    "solar (MW)": "solar_mw",
    "nuclear (%)": "nuclear_pct",
    "hydro (%)": "hydro_pct",
    "gas (%)": "gas_pct",
    "wind (%)": "wind_pct",
    "biofuel (%)": "biofuel_pct",
    "solar (%)": "solar_pct",
    "Imports (MW)": "imports_mw",
    "Exports (MW)": "exports_mw",
    "Net Import/Exports (MW)": "net_import_exports_mw",
    "Power Generated (MW)": "power_generated_mw",
    "Ontario Demand (MW)": "ontario_demand_mw",
    "Total Emissions (tonnes)": "total_emissions_tonnes",
    "CO2e Intensity (g/kWh)": "co2e_intensity_gco2_per_kwh",
}

# Rate-table headers with special handling.
DATE_HEADER = "Effective date"
THRESHOLD_HEADER = "Residential threshold for lower tier price (kWh per month)"
HIGHER_HEADER = "Higher tier price (¢ per kWh)"
LOWER_HEADER = "Lower tier price (¢ per kWh)"
RATE_UNIT = " ¢ per kWh"
# Accepted effective-date layouts (cell cleaning removes commas).
DATE_FORMATS = ["MMMM d yyyy", "MMM d yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyy-MM-dd"]


def rename_keep(df: DataFrame, mapping: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Rename by dictionary and keep only the mapped columns (plus ``keep``)."""
    cols = [F.col(f"`{c}`").alias(mapping[c]) for c in df.columns if c in mapping]
    return df.select(*[F.col(k) for k in keep], *cols)


def _ordered(hist: DataFrame) -> DataFrame:
    """With ``_row``, the order for first-wins: the scan's, else the frame's."""
    return hist if ROW in hist.columns else hist.withColumn(ROW, F.monotonically_increasing_id())


def readings_history(hist: DataFrame) -> DataFrame:
    """M7 body: UTC-normalised timestamp, mapped columns, first row per timestamp."""
    d = _ordered(hist).withColumn("timestamp", to_utc_naive(F.col("timestamp")))
    d = rename_keep(d, READINGS_COLUMN_MAP, keep=["timestamp", "_row"])
    d = d.select("timestamp", "_row", *[F.col(c).cast("double") for c in d.columns if c not in ("timestamp", "_row")])
    return dedupe_first(d, ["timestamp"], ["_row"]).drop("_row")


def generation_history(hist: DataFrame, mapping: DataFrame | None) -> DataFrame:
    """M6 body: plant columns → fuel sums (dictionary, else rules; unknown →
    other), reported TOTAL preferred, first row per UTC timestamp."""
    d = hist.toDF(*[c.strip() for c in hist.columns])
    d = d.withColumn("timestamp", to_utc_naive(F.col("timestamp")))
    fuels = plants_to_fuels(d, ["timestamp"], mapping, total_col="TOTAL", classes=FUELS)
    first = dedupe_first(fuels, ["timestamp"], ["_row"]).drop("_row")
    return first.select("timestamp", *FUELS, "total")


def rates_history(hist: DataFrame, label_col: str = "rate_type") -> DataFrame:
    """Historical rate CSVs (index = date, one column per rate) → long form;
    first row per (date, type, column). Values already numeric."""
    ids = ["effective_date", label_col, ROW]
    d = _ordered(hist).withColumnRenamed(hist.columns[0], "effective_date")
    d = d.withColumn("effective_date", iso_seconds(F.col("effective_date").cast("timestamp_ntz")).substr(1, 10))
    values = [c for c in d.columns if c not in ids]
    long = melt(d, ids, values, "rate_column", "value_cents_per_kwh", value_type="string")
    long = long.withColumn("value_cents_per_kwh", parse_numeric("value_cents_per_kwh"))
    return dedupe_first(long, ["effective_date", label_col, "rate_column"], ["_row"]).drop("_row")


def rates_from_tables(tables: DataFrame) -> DataFrame:
    """Rate tables (one row per body row, see ``html_tables``) → long rates
    (M8: F3 → F9 → F15 → F4 → F7 → F8 → F5 → A1).

    A table with an unparsable effective date is skipped as a whole, like the
    source's per-table exception handling. Cells beyond the header count are
    ignored; short rows are padded with ''."""
    t = tables.withColumn("headers", F.transform("headers", lambda h: clean_header(h)))
    n = F.size("headers")
    cells = F.slice(pad_array("cells", n), 1, n)
    t = t.withColumn("cells", F.transform(cells, lambda c: F.replace(clean_cell(c), F.lit(RATE_UNIT), F.lit(""))))
    pairs = F.arrays_zip(F.col("headers").alias("h"), F.col("cells").alias("c"))
    t = t.withColumn("_pairs", pairs)

    def lookup(name: str):
        hits = F.filter("_pairs", lambda p: p["h"] == F.lit(name))
        return F.when(F.size(hits) > 0, F.element_at(hits, -1)["c"])

    date_s = lookup(DATE_HEADER)
    t = t.withColumn(
        "effective_date",
        F.coalesce(*[F.try_to_timestamp(date_s, F.lit(p)) for p in DATE_FORMATS]).cast("date"),
    )
    tw = Window.partitionBy("page_id", "table_pos")
    t = t.withColumn("_table_ok", F.min(F.col("effective_date").isNotNull().cast("int")).over(tw) == 1)
    t = t.filter("_table_ok")

    has_thr = F.array_contains("headers", THRESHOLD_HEADER)
    has_hi = F.array_contains("headers", HIGHER_HEADER)
    thr = lookup(THRESHOLD_HEADER)
    summer, winter = seasonal_split(thr)
    hi_f, summer_f, winter_f = conditional_fill(lookup(HIGHER_HEADER), lookup(LOWER_HEADER), summer, winter)
    blank_fill = has_thr & has_hi
    t = (
        t.withColumn("_summer", F.when(blank_fill, summer_f).otherwise(summer))
        .withColumn("_winter", F.when(blank_fill, winter_f).otherwise(winter))
        .withColumn("_higher", F.when(blank_fill, hi_f).otherwise(lookup(HIGHER_HEADER)))
    )
    # dedupe header names (last one wins, as a dict keyed by header would)
    t = t.withColumn("_names", F.array_distinct("headers"))
    long = t.select(
        "page_id", "table_pos", "row_pos", "rate_type", "effective_date", "_pairs", "_summer", "_winter", "_higher",
        has_thr.alias("_has_thr"),
        F.explode("_names").alias("rate_column"),
    ).filter(F.col("rate_column") != F.lit(DATE_HEADER))
    hits = F.filter("_pairs", lambda p: p["h"] == F.col("rate_column"))
    cell = F.element_at(hits, -1)["c"]
    is_thr = (F.col("rate_column") == F.lit(THRESHOLD_HEADER)) & F.col("_has_thr")
    base = long.filter(~is_thr).select(
        "effective_date",
        "rate_type",
        "rate_column",
        F.when(F.col("rate_column") == F.lit(HIGHER_HEADER), F.col("_higher")).otherwise(cell).alias("_v"),
    )
    seasonal = long.filter(is_thr).select(
        "effective_date",
        "rate_type",
        F.explode(
            F.array(
                F.struct(F.lit(THRESHOLD_HEADER + " [Summer]").alias("rate_column"), F.col("_summer").alias("_v")),
                F.struct(F.lit(THRESHOLD_HEADER + " [Winter]").alias("rate_column"), F.col("_winter").alias("_v")),
            )
        ).alias("_s"),
    ).select("effective_date", "rate_type", "_s.rate_column", "_s._v")
    out = base.unionByName(seasonal)
    return out.select(
        "effective_date",
        F.trim(F.col("rate_type")).alias("rate_type"),
        "rate_column",
        parse_numeric(F.col("_v")).alias("value_cents_per_kwh"),
    )


def rates_from_pages(pages: DataFrame) -> DataFrame:
    """Rates page(s) → long rates (M8)."""
    return rates_from_tables(html_tables(pages))
