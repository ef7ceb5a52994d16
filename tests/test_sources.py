"""Landing scans and the rates page parse, on inline fixtures written to a
fresh scratch folder."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from ampere.operators.reshape import plants_to_fuels
from ampere.plans.backfill import generation_history, rates_from_pages, readings_history, rates_history
from ampere.schemas import FUELS
from ampere.sources.files import (
    latest_nonempty_mapping,
    month_file_paths,
    plan_months,
    scan_fuel_csv,
    scan_generation,
    scan_generator_xml,
    scan_hist_csv,
    scan_plant_wide,
)
from ampere.sources.html import extract_labelled, html_tables

CSV_FUELS = ["nuclear", "gas", "hydro", "wind", "solar", "biofuel", "total"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_fuel_csv(spark, scratch):
    write(
        f"{scratch}/202405.csv",
        "Date,Hour,Nuclear,Gas,Hydro,Wind,Solar,Biofuel,Total\n"
        "2024-05-01,1,9000,1200,4000,800,10,5,15015\n"
        "2024-05-01,2,9001,1100,4001,,11,5,15000\n"
        "2024-05-01,24,9002,1000,4002,700,0,5,14709\n"
        "Data are preliminary,,,,,,,,\n",
    )
    # ours: padded headers and an absent fuel column in a second month
    write(f"{scratch}/202406.csv", " Date , Hour ,Nuclear,Gas,Hydro,Wind,Solar,Total\n2024-06-01,3,1,2,3,4,5,15\n")
    paths = month_file_paths(scratch, dt.date(2024, 5, 1), dt.date(2024, 7, 15))
    assert [os.path.basename(p) for p in paths] == ["202405.csv", "202406.csv", "202407.csv"]
    df = scan_fuel_csv(spark, paths, CSV_FUELS)
    rows = sorted(df.collect(), key=lambda r: r.timestamp)
    assert len(rows) == 4
    assert rows[0].timestamp == dt.datetime(2024, 5, 1, 0) and rows[1].timestamp == dt.datetime(2024, 5, 1, 1)
    assert rows[2].timestamp == dt.datetime(2024, 5, 1, 23)
    assert rows[0].nuclear == 9000.0 and rows[0].total == 15015.0 and rows[0].other is None
    assert rows[1].wind is None
    assert rows[3].biofuel is None and rows[3].solar == 5.0


def test_fuel_csv_missing_file_is_empty(spark, scratch):
    df = scan_fuel_csv(spark, [f"{scratch}/190001.csv"], CSV_FUELS)
    assert df.count() == 0 and "timestamp" in df.columns


def test_plan_months_rolls_year():
    assert plan_months(dt.date(2023, 11, 20), dt.date(2024, 2, 1)) == [
        dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    ]


def _plant_frame(spark):
    rows = [
        (dt.date(2015, 3, 1), 1, 100.0, 50.0, 20.0, 175.0, 5.0),
        (dt.date(2015, 3, 1), 2, 110.0, None, 21.0, None, 6.0),
        (None, 3, 1.0, 1.0, 1.0, 1.0, 1.0),
    ]
    return spark.createDataFrame(
        rows, "DATE date, HOUR int, `PICKERING G1` double, `SIR ADAM BECK 1` double, `NEW PLANT X` double, TOTAL double, `MYSTERY 9` double"
    )


def test_plant_wide_with_mapping(spark):
    wide = scan_plant_wide(_plant_frame(spark))
    mapping = spark.createDataFrame([("NEW PLANT X", "wind"), ("MYSTERY 9", "coal")], "_mkey string, _mclass string")
    out = plants_to_fuels(wide, ["timestamp"], mapping, classes=FUELS).drop("_row")
    rows = sorted(out.collect(), key=lambda r: r.timestamp)
    assert len(rows) == 2  # null DATE dropped
    r0, r1 = rows
    assert r0.timestamp == dt.datetime(2015, 3, 1, 0) and r1.timestamp == dt.datetime(2015, 3, 1, 1)
    assert (r0.nuclear, r0.hydro, r0.wind, r0.other) == (100.0, 50.0, 20.0, 5.0)  # unknown class → other
    assert r0.total == 175.0  # reported total preferred
    assert r1.hydro == 0.0 and r1.total == 110.0 + 21.0 + 6.0  # null TOTAL → sum of classes


def test_plant_date_range_misses_everything(spark):
    wide = scan_plant_wide(_plant_frame(spark)).filter(F.col("timestamp") >= F.lit("2030-01-01").cast("timestamp_ntz"))
    assert plants_to_fuels(wide, ["timestamp"], None, classes=FUELS).count() == 0


XML = """<?xml version="1.0" encoding="UTF-8"?>
<Document xmlns="http://example.org/grid/schema">
  <DocBody>
    <Generators>
      <Generator><GeneratorName> New Plant X </GeneratorName><FuelType>WIND</FuelType></Generator>
      <Generator><GeneratorName>Pickering G1</GeneratorName><FuelType>NUCLEAR</FuelType></Generator>
    </Generators>
  </DocBody>
</Document>"""


def test_generator_xml_and_latest(spark, scratch):
    write(f"{scratch}/xml/generator_report_20240101.xml", XML.replace("WIND", "SOLAR"))
    write(f"{scratch}/xml/generator_report_20240102.xml", XML)
    gens = scan_generator_xml(spark, [f"{scratch}/xml/*.xml"])
    m = {r._mkey: r._mclass for r in latest_nonempty_mapping(gens).collect()}
    assert m == {"NEW PLANT X": "wind", "PICKERING G1": "nuclear"}
    assert scan_generator_xml(spark, [f"{scratch}/nope/*.xml"]).count() == 0


def test_historical_generation_and_readings(spark, scratch):
    write(
        f"{scratch}/hist/2016.csv",
        ",PICKERING G1 , NEW PLANT X,total\n"
        "2016-01-01 00:00:00-05:00,100,5,\n"
        "2016-01-01 01:00:00-05:00,101, ,200\n"
        "2016-01-01 00:00:00-05:00,999,9,1\n",
    )
    hist = scan_hist_csv(spark, [f"{scratch}/hist/*.csv"])
    out = generation_history(hist, None)
    rows = sorted(out.collect(), key=lambda r: r.timestamp)
    assert [r.timestamp for r in rows] == [dt.datetime(2016, 1, 1, 5), dt.datetime(2016, 1, 1, 6)]
    assert rows[0].nuclear == 100.0 and rows[0].other == 5.0 and rows[0].total == 105.0  # first row wins; unmapped → other
    assert rows[1].other == 0.0 and rows[1].total == 200.0

    write(
        f"{scratch}/gw/summary.csv",
        ",nuclear (MW),Imports (MW),junk\n2020-01-01 00:00:00-05:00,9000,100,x\n2020-01-01 00:00:00-05:00,1,1,y\n",
    )
    r = readings_history(scan_hist_csv(spark, [f"{scratch}/gw/summary.csv"]))
    assert r.columns == ["timestamp", "nuclear_mw", "imports_mw"]
    assert [tuple(x) for x in r.collect()] == [(dt.datetime(2020, 1, 1, 5), 9000.0, 100.0)]


def test_rates_history_label_from_file(spark, scratch):
    write(f"{scratch}/rates/Tiered rates.csv", ",Lower tier,Higher tier\n2024-05-01,9.3,11.0\n2023-11-01,9.1,\n")
    hist = scan_hist_csv(spark, [f"{scratch}/rates/*.csv"], index="effective_date", label="rate_type")
    rows = sorted(tuple(r) for r in rates_history(hist).collect())
    assert rows[0] == ("2023-11-01", "Tiered rates", "Higher tier", None)
    assert ("2024-05-01", "Tiered rates", "Lower tier", 9.3) in rows and len(rows) == 4


RATES_HTML = """<html><body>
<h2>Time-of-Use (TOU) rates<a id="tou"></a></h2>
<h2>Single</h2>
<h2>Tiered rates <span>*</span></h2>
<table>
 <tr><th>Effective\xa0date</th><th>Off-peak*</th><th>On-peak</th></tr>
 <tr><td>May 1, 2024</td><td>8.7 ¢ per kWh</td><td>18.2 ¢ per kWh</td></tr>
 <tr><td>November 1, 2023</td><td>7.4 ¢ per kWh</td></tr>
</table>
<table>
 <tr><th>Effective date</th><th>Lower tier price (¢ per kWh)</th><th>Higher tier price (¢ per kWh)</th>
     <th>Residential threshold for lower tier price (kWh per month)</th></tr>
 <tr><td>May 1, 2024</td><td>9.3 ¢ per kWh</td><td>11.0 ¢ per kWh</td><td>600 (Summer)  1,000 (Winter)</td></tr>
 <tr><td>May 1, 2015</td><td>8.8 ¢ per kWh</td><td></td><td>750</td></tr>
</table>
<table><tr><th>Effective date</th><th>X</th></tr><tr><td>1 May 2024</td><td>1</td></tr></table>
</body></html>"""


def test_rates_page(spark):
    pages = spark.createDataFrame([(7, RATES_HTML)], "page_id long, html string")
    t = html_tables(pages).collect()
    assert {r.rate_type for r in t} == {"Time-of-Use (TOU) rates", "Tiered rates"}  # single-child h2 skipped
    out = {(r.effective_date, r.rate_type, r.rate_column): r.value_cents_per_kwh for r in rates_from_pages(pages).collect()}
    tou = "Time-of-Use (TOU) rates"
    assert out[(dt.date(2024, 5, 1), tou, "Off-peak")] == 8.7
    assert out[(dt.date(2024, 5, 1), tou, "On-peak")] == 18.2
    assert out[(dt.date(2023, 11, 1), tou, "On-peak")] is None  # short row padded with ''
    thr = "Residential threshold for lower tier price (kWh per month)"
    assert out[(dt.date(2024, 5, 1), "Tiered rates", thr + " [Summer]")] == 600.0
    assert out[(dt.date(2024, 5, 1), "Tiered rates", thr + " [Winter]")] == 1000.0
    assert out[(dt.date(2015, 5, 1), "Tiered rates", thr + " [Summer]")] == 0.0  # blank higher tier
    assert out[(dt.date(2015, 5, 1), "Tiered rates", "Higher tier price (¢ per kWh)")] == 8.8
    assert len(out) == 4 + 8  # two TOU rows × 2 columns; two tiered rows × 4 columns


def test_extract_labelled(spark):
    page = '<div><p>POWER GENERATED</p></div><div>15,234 MW</div><span bind="imports">1,020 MW</span>'
    df = spark.createDataFrame([(1, page)], "id long, html string")
    out = extract_labelled(
        df, "html",
        {"power_generated_mw": r"POWER GENERATED</p></div><div>([^<]*)</div>", "imports_mw": r'bind="imports">([^<]*)<'},
        numeric={"power_generated_mw": [" MW"], "imports_mw": [" MW"]}, keep=["id"],
    ).collect()[0]
    assert out.power_generated_mw == 15234.0 and out.imports_mw == 1020.0


def test_scan_generation_eras(spark, scratch):
    write(f"{scratch}/plants/2018.csv", "Date,Hour,PICKERING G1,TOTAL\n2018-12-31,24,100,\n2018-06-01,1,5,\n")
    write(f"{scratch}/csv/201905.csv", "Date,Hour,Nuclear,Gas,Hydro,Wind,Solar,Biofuel,Total\n2019-05-01,1,1,2,3,4,5,6,21\n")
    out = scan_generation(
        spark, {2018: [f"{scratch}/plants/2018.csv"]}, f"{scratch}/csv", dt.date(2018, 12, 1), dt.date(2019, 5, 31)
    )
    rows = sorted(out.collect(), key=lambda r: r.timestamp)
    assert [r.timestamp for r in rows] == [dt.datetime(2018, 12, 31, 23), dt.datetime(2019, 5, 1, 0)]
    assert rows[0].nuclear == 100.0 and rows[0].total == 100.0 and rows[1].other is None and rows[1].total == 21.0


def test_drop_quirks_and_mapping_window(spark, scratch):
    from ampere.sources.files import drop_quirks

    df = spark.createDataFrame([(1, 2, 3)], "`Unnamed: 2` int, a int, b int")
    assert drop_quirks(df, 2010).columns == ["a", "b"]
    assert drop_quirks(df, 2012).columns == ["Unnamed: 2", "b"]
    assert drop_quirks(df, 2015).columns == ["Unnamed: 2", "a", "b"]
    write(f"{scratch}/xml/generator_report_20240101.xml", XML)
    gens = scan_generator_xml(spark, [f"{scratch}/xml/*.xml"])
    assert latest_nonempty_mapping(gens, asof=dt.date(2024, 1, 5)).count() == 2
    assert latest_nonempty_mapping(gens, asof=dt.date(2024, 3, 1)).count() == 0  # too old → empty mapping


def test_empty_mapped_class_falls_through_to_rules(spark):
    from ampere.operators.reshape import classify_lookup

    df = spark.createDataFrame([("Lennox G1",), ("Plant Z",), ("Plant Y",)], "name string")
    mapping = spark.createDataFrame([("LENNOX G1", ""), ("PLANT Z", "hydro"), ("PLANT Y", "coal")], "_mkey string, _mclass string")
    got = {r.name: r["class"] for r in classify_lookup(df, "name", mapping, FUELS).collect()}
    assert got == {"Lennox G1": "gas", "Plant Z": "hydro", "Plant Y": "other"}


def test_heading_with_leading_element_counts_children(spark):
    html = "<h2><span>x</span>Tiered</h2><table><tr><th>Effective date</th><th>A</th></tr><tr><td>May 1, 2024</td><td>1</td></tr></table>"
    rows = html_tables(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    assert len(rows) == 1 and rows[0].headers == ["Effective date", "A"] and rows[0].cells == ["May 1, 2024", "1"]


def test_fuel_csv_wide_blank_header_and_date_not_first(spark, scratch):
    import os

    from ampere.sources.files import scan_fuel_csv

    os.makedirs(f"{scratch}/f")
    extra = [f"x{i}" for i in range(70)]
    with open(f"{scratch}/f/a.csv", "w") as f:
        f.write(",".join(["Hour", "Date", "", *extra, "Nuclear"]) + "\n")
        f.write(",".join(["1", "2024-05-01", "", *["0"] * 70, "12.5"]) + "\n")
    rows = scan_fuel_csv(spark, [f"{scratch}/f/a.csv"], ["nuclear"]).collect()
    assert [(str(r.timestamp), r.nuclear) for r in rows] == [("2024-05-01 00:00:00", 12.5)]


def test_fuel_csv_bad_row_raises_or_is_left_out(spark, scratch):
    write(f"{scratch}/bad.csv", "Date,Hour,Gas\n2024-05-01,1,7\nsoon,2,8\n")
    with pytest.raises(Exception, match="no date and hour"):
        scan_fuel_csv(spark, [f"{scratch}/bad.csv"], ["gas"]).collect()
    assert [r.gas for r in scan_fuel_csv(spark, [f"{scratch}/bad.csv"], ["gas"], on_bad="drop").collect()] == [7.0]


def test_hist_csv_by_name_and_first_file_wins(spark, scratch):
    write(f"{scratch}/h/2010.csv", ",A NUCLEAR,B WIND,TOTAL\n2010-01-01 00:00:00-05:00,100,5,105\n")
    late = "".join(f"2011-01-01 {h:02d}:00:00-05:00,{h},7,1,{h + 8}\n" for h in range(24))
    write(f"{scratch}/h/2011.csv", ",B WIND,A NUCLEAR,C SOLAR,TOTAL\n2010-01-01 00:00:00-05:00,9,9,9,27\n" + late)
    out = generation_history(scan_hist_csv(spark, [f"{scratch}/h/*.csv"]), None)
    rows = {r.timestamp: r for r in out.collect()}
    first = rows[dt.datetime(2010, 1, 1, 5)]
    assert (first.nuclear, first.wind, first.solar, first.total) == (100.0, 5.0, 0.0, 105.0)
    r = rows[dt.datetime(2011, 1, 1, 8)]
    assert (r.nuclear, r.wind, r.solar, r.total) == (7.0, 3.0, 1.0, 11.0) and len(rows) == 25

    write(f"{scratch}/r/Tiered rates.csv", ",Lower tier,Higher tier\n2024-05-01,9.3,11.0\n")
    write(f"{scratch}/r/TOU rates.csv", ",On-peak,Mid-peak\n2024-05-01,15.8,12.2\n")
    hist = scan_hist_csv(spark, [f"{scratch}/r/*.csv"], index="effective_date", label="rate_type")
    got = {(r.rate_type, r.rate_column): r.value_cents_per_kwh for r in rates_history(hist).collect() if r.value_cents_per_kwh}
    assert got == {
        ("Tiered rates", "Lower tier"): 9.3, ("Tiered rates", "Higher tier"): 11.0,
        ("TOU rates", "On-peak"): 15.8, ("TOU rates", "Mid-peak"): 12.2,
    }


def test_headings_and_links_with_markup(spark):
    from ampere.sources.html import html_headings, html_list_items

    html = '<h1 class="x">Rates <b>now</b></h1><ul><li class="a"><a id="1" href="/t">Time <i>of</i> use</a></li></ul>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.heading for r in html_headings(pages).collect()] == ["Rates now"]
    assert [(r.href, r.text) for r in html_list_items(pages).collect()] == [("/t", "Time of use")]


def test_scan_generation_clips_workbooks_to_their_era(spark, scratch):
    write(f"{scratch}/p/2019.csv", "Date,Hour,PICKERING G1,TOTAL\n2019-04-30,24,100,\n2019-05-01,1,7,\n")
    write(f"{scratch}/p/2011.csv", "no,such,layout\n1,2,3\n")
    write(f"{scratch}/csv/201905.csv", "Date,Hour,Nuclear,Total\n2019-05-01,1,1,21\n")
    out = scan_generation(
        spark, {2011: [f"{scratch}/p/2011.csv"], "2019": [f"{scratch}/p/2019.csv"]}, f"{scratch}/csv", dt.date(2019, 1, 1), dt.date(2019, 5, 31)
    )
    rows = sorted(out.collect(), key=lambda r: r.timestamp)
    assert [(r.timestamp, r.nuclear) for r in rows] == [(dt.datetime(2019, 4, 30, 23), 100.0), (dt.datetime(2019, 5, 1), 1.0)]
