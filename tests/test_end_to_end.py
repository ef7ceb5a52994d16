"""The README's daily run, end to end on local scratch folders: landed CSVs →
gated keyed load into month partitions → staging + marts → reports → gate."""

import datetime as dt
import os

from ampere.operators import quality
from ampere.plans import dashboard
from ampere.plans.load import load_batch
from ampere.plans.marts import build_marts
from ampere.schemas import GENERATION_SPEC
from ampere.sources.files import month_file_paths, scan_fuel_csv

FUELS = ["nuclear", "gas", "hydro", "wind", "solar", "biofuel", "total"]


def _csv(path, day, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("Date,Hour,Nuclear,Gas,Hydro,Wind,Solar,Biofuel,Total\n")
        for h, vals in rows:
            f.write(f"{day},{h}," + ",".join(str(v) for v in vals) + "\n")


def test_daily_run(spark, scratch):
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    _csv(f"{landing}/202405.csv", "2024-05-31", [(h, (9000, 1000, 4000, 500, 100, 10, 14610)) for h in range(1, 25)])
    _csv(f"{landing}/202406.csv", "2024-06-01", [(h, (9100, 900, 4100, 400, 0, 10, 14510)) for h in range(1, 4)])
    paths = month_file_paths(landing, dt.date(2024, 5, 1), dt.date(2024, 7, 1))
    batch = scan_fuel_csv(spark, paths, FUELS)
    status = load_batch(
        spark, GENERATION_SPEC, batch.select(*GENERATION_SPEC.schema.fieldNames()),
        f"{lake}/raw/generation_live", "generation", run_log=f"{lake}/runs",
        asof=dt.datetime(2024, 6, 2), partition_by=["month"],
    )
    assert status == "success"
    assert sorted(p for p in os.listdir(f"{lake}/raw/generation_live") if p.startswith("month=")) == [
        "month=2024-05", "month=2024-06"
    ]
    marts = build_marts(spark, f"{lake}/raw", f"{lake}/marts")
    fg = marts["fct_generation"]
    assert fg.count() == 27
    hist = dashboard.generation_full_history(fg).collect()
    assert [r.month for r in hist] == [dt.datetime(2024, 5, 1), dt.datetime(2024, 6, 1)]
    assert hist[0].avg_nuclear == 9000.0 and hist[0].avg_total == 14610.0
    latest = dashboard.latest(marts["fct_intensity"]).collect()[0]
    assert latest.hour == dt.datetime(2024, 6, 1, 2) and latest.co2e_intensity_gco2_per_kwh is None
    report = quality.validation_report(
        quality.keyed_checks(fg, "hour", ["clean_pct"], {"total_mw": (0, 30000)}),
        quality.continuity_check(fg, "hour", 2 * 86400),
    )
    assert quality.gate_exit_code(report) == 0
    assert [r.status for r in spark.read.parquet(f"{lake}/runs").collect()] == ["success"]
