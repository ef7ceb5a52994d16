"""Landed page of live readings → one typed record per page.

The page shows a value beside a ``<span bind="...">`` in the same ``div``, and
totals in the ``div`` that follows the one whose paragraph holds their label.
All of it is one projection over the page; no Python, no shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.functions.numeric import parse_numeric, strip_units
from ampere.functions.text import camel_to_snake
from ampere.functions.time import parse_reading_time
from ampere.schemas import READING_MEASURES, READING_SOURCES
from ampere.sources.tag_stream import decode_references

# Names bound on the page.
TIME_NAME = "timeOfReading"
FLOW_NAMES = ["imports", "exports", "netImportExports"]
# Labels of the totals, their columns and units.
TOTALS = {
    "POWER GENERATED": ("power_generated_mw", "MW"),
    "ONTARIO DEMAND": ("ontario_demand_mw", "MW"),
    "TOTAL EMISSIONS": ("total_emissions_tonnes", "tonnes"),
    "CO2e INTENSITY": ("co2e_intensity_gco2_per_kwh", "g/kWh"),
}

#: Markup and text without a ``div``'s start or end.
_INNER = r"[^<]*+(?:<(?!/?div\b)[^<]*+)*+"


def _text(markup: Column) -> Column:
    """What a reader sees of it; null where the page has no such place."""
    shown = decode_references(F.regexp_replace(markup, "<[^>]*>", ""))
    return F.nullif(F.btrim(F.regexp_replace(shown, r"[\s ]+", " ")), F.lit(""))


def bound(page: Column, name: str) -> Column:
    """The text of the ``div`` that directly holds the span bound to ``name``."""
    span = rf"""<span\b[^>]*\bbind\s*=\s*["']{name}["']"""
    before = rf"[^<]*+(?:<(?!/?div\b|span\b[^>]*\bbind\s*=\s*[\"']{name}[\"'])[^<]*+)*+"
    return _text(F.regexp_extract(page, rf"(?is)<div\b[^>]*>({before}{span}[^>]*>{_INNER})</div", 1))


def labelled(page: Column, label: str) -> Column:
    """The text of the ``div`` behind the one with a paragraph that holds ``label``."""
    pattern = rf"(?s)<p\b[^>]*>[^<]*\Q{label}\E[^<]*</p>{_INNER}</div>\s*<div\b[^>]*>({_INNER})</div"
    return _text(F.regexp_extract(page, pattern, 1))


def readings_from_pages(
    pages: DataFrame, asof: dt.date | Column, html: str = "html", keep: Sequence[str] = ()
) -> DataFrame:
    """``(timestamp, the 19 measures)`` of each page, local time.

    A value that is missing or no number is NULL. A page whose time of reading
    is missing or not a time yet (it is still being updated) has no record.
    ``asof`` is the day the page was landed, which gives the label its year.
    """
    page = F.col(html)

    def number(text: Column, *units: str) -> Column:
        return parse_numeric(strip_units(text, [f" {u}" for u in units] + list(units)))

    values = {f"{c}_mw": number(bound(page, n), "MW") for n, c in ((n, _snake(n)) for n in FLOW_NAMES)}
    values |= {column: number(labelled(page, label), unit) for label, (column, unit) in TOTALS.items()}
    for source in READING_SOURCES:
        values[f"{source}_mw"] = number(bound(page, f"{source}Output"), "MW")
        values[f"{source}_pct"] = number(bound(page, f"{source}Percentage"), "%")
    out = pages.select(*keep, bound(page, TIME_NAME).alias("_label"), *[values[c].alias(c) for c in READING_MEASURES])
    out = out.withColumn("timestamp", parse_reading_time("_label", asof))
    return out.where(F.col("timestamp").isNotNull()).select(*keep, "timestamp", *READING_MEASURES)


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)
