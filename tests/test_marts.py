"""Staging and marts (fixture 11): priorities, NULL defaults, guarded share,
full outer join on the hour, missing tables."""

import datetime as dt

from ampere.plans import dashboard, staging
from ampere.plans.marts import build_marts, fct_generation, fct_intensity
from ampere.schemas import FUELS, GENERATION_RAW, READINGS_RAW, READING_MEASURES

H = lambda h: dt.datetime(2024, 3, 1, h)


def gen_rows(spark, rows):
    return spark.createDataFrame(rows, GENERATION_RAW)


def test_staging_and_marts(spark):
    # (timestamp, nuclear, gas, hydro, wind, solar, biofuel, other, total)
    hist = gen_rows(spark, [
        (H(0), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 6.0),
        (H(1), 5.0, 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 10.0),
        (H(2), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ])
    live = gen_rows(spark, [
        (H(1), 8.0, None, 2.0, None, None, None, None, 10.0),  # live wins; NULL fuel → 0
        (H(3), 4.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, 4.0),  # hour only in generation
    ])
    stg = staging.stg_generation(spark, hist, live)
    got = {r.ts: r for r in stg.collect()}
    assert set(got) == {H(0), H(1), H(2), H(3)}
    assert got[H(1)].nuclear_mw == 8.0 and got[H(1)].gas_mw == 0.0 and got[H(1)].other_mw == 0.0
    fg = fct_generation(stg)
    f = {r.hour: r for r in fg.collect()}
    assert f[H(1)].clean_pct == 100.0  # (8 + 2) / 10
    assert f[H(2)].clean_pct is None  # total 0 → NULL share
    assert f[H(0)].clean_pct == 83.3  # 5 of 6, rounded to one decimal
    assert "other_mw" not in fg.columns

    rd_cols = ["timestamp"] + READING_MEASURES
    def rd(ts, co2):
        vals = {c: None for c in READING_MEASURES}
        vals["co2e_intensity_gco2_per_kwh"] = co2
        vals["nuclear_mw"] = 1.0
        return (ts, *[vals[c] for c in READING_MEASURES])
    readings = spark.createDataFrame(
        [rd(H(0) + dt.timedelta(minutes=5), 30.0), rd(H(0) + dt.timedelta(minutes=35), 31.0), rd(H(5), 50.0)],
        READINGS_RAW,
    )
    srd = staging.stg_readings(spark, None, readings)
    for strategy in ("split", "native"):
        fi = fct_intensity(fg, srd, strategy=strategy)
        rows = fi.collect()
        by_hour = {}
        for r in rows:
            by_hour.setdefault(r.hour, []).append(r)
        assert len(by_hour[H(0)]) == 2  # two readings in one hour fan out
        assert all(r.has_generation and r.has_readings for r in by_hour[H(0)])
        assert [(r.has_generation, r.has_readings) for r in by_hour[H(5)]] == [(False, True)]  # only in readings
        assert [(r.has_generation, r.has_readings) for r in by_hour[H(3)]] == [(True, False)]  # only in generation
        assert by_hour[H(5)][0].gw_nuclear_mw == 1.0 and by_hour[H(5)][0].nuclear_mw is None
        assert len(rows) == 6

    latest = dashboard.latest(fct_intensity(fg, srd)).collect()
    assert latest[0].hour == H(5)
    co2 = dashboard.co2_full_history(fct_intensity(fg, srd)).collect()
    assert (co2[0].avg_co2_intensity, co2[0].min_co2_intensity, co2[0].max_co2_intensity) == (37.0, 30.0, 50.0)


def test_missing_tables(spark):
    empty = staging.stg_generation(spark, None, None)
    assert empty.count() == 0 and empty.columns == ["ts"] + [f"{f}_mw" for f in FUELS + ["total"]]
    assert staging.stg_readings(spark, None, None).count() == 0
    assert staging.stg_rates(spark, None, None).count() == 0


def test_rates_staging_and_reports(spark):
    rates = spark.createDataFrame(
        [
            ("2024-05-01", "Time-of-Use (TOU) rates", "Off-peak", 7.6),
            ("2024-05-01", "Time-of-Use (TOU) rates", "On-peak", 15.8),
            ("2023-11-01", "Time-of-Use (TOU) rates", "Off-peak", 7.4),
            ("2024-05-01", "Tiered rates", "Lower", 9.3),
        ],
        "effective_date string, rate_type string, rate_column string, value_cents_per_kwh double",
    )
    live = spark.createDataFrame(
        [("2024-05-01", "Time-of-Use (TOU) rates", "Off-peak", 8.7)],
        "effective_date string, rate_type string, rate_column string, value_cents_per_kwh double",
    )
    stg = staging.stg_rates(spark, rates, live)
    cur = [tuple(r) for r in dashboard.current_rates(stg).collect()]
    assert cur == [("On-peak", 15.8), ("Off-peak", 8.7)]
    hist = dashboard.rate_history(stg, n=2).collect()
    assert [(r.effective_date, r.rate_column) for r in hist] == [(dt.date(2024, 5, 1), "Off-peak"), (dt.date(2024, 5, 1), "On-peak")]


def test_build_marts_from_files(spark, scratch):
    raw = f"{scratch}/raw"
    gen_rows(spark, [(H(0), 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)]).write.parquet(f"{raw}/generation_live")
    marts = build_marts(spark, raw, f"{scratch}/marts")
    assert marts["fct_generation"].count() == 1
    assert marts["fct_intensity"].count() == 1
    assert spark.sql("select count(*) from fct_intensity").collect()[0][0] == 1


def test_staging_normalises_source_time_zone(spark):
    """§1.4: a source declared in a local zone is converted to UTC in staging;
    without a zone the wall clock is kept (the source's own behaviour)."""
    live = gen_rows(spark, [
        (dt.datetime(2024, 1, 15, 8), 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0),   # EST, UTC-5
        (dt.datetime(2024, 7, 15, 8), 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0),   # EDT, UTC-4
    ])
    utc = sorted(r.ts for r in staging.stg_generation(spark, None, live, source_tz="America/Toronto").collect())
    assert utc == [dt.datetime(2024, 1, 15, 13), dt.datetime(2024, 7, 15, 12)]
    kept = sorted(r.ts for r in staging.stg_generation(spark, None, live).collect())
    assert kept == [dt.datetime(2024, 1, 15, 8), dt.datetime(2024, 7, 15, 8)]
