"""Landing-file scans.

Files are read by Spark's own readers (CSV, XML, Parquet) with explicit
schemas where the layout is known. Provenance comes from the hidden
``_metadata`` column, so a label encoded in a file name (year, rate type)
is a column expression, not a driver-side loop over files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.functions.text import normalize_header_name
from ampere.functions.time import hour_ending_to_start
from ampere.sources import lines

#: Column that orders the rows of a scan by file and position.
ROW = "_row"
# Junk columns of some yearly plant workbooks, by year.
QUIRK_COLUMNS = {2010: "Unnamed: 2", 2011: "Unnamed: 2", 2012: "a"}
# The three eras of the generation source.
ERA_EXCEL_END = dt.date(2018, 12, 31)
ERA_EXCEL_2019 = (dt.date(2019, 1, 1), dt.date(2019, 4, 30))
ERA_CSV_START = dt.date(2019, 5, 1)


def _matches(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[str]]:
    """Each path (globs allowed) and the files or folders it stands for. A
    folder is listed once, however many of its files are asked for (S5)."""
    paths = list(paths)
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    folders: dict[str, dict[str, str]] = {}
    out: dict[str, list[str]] = {}
    for p in paths:
        folder, _, name = p.rstrip("/").rpartition("/")
        if any(c in p for c in "*?[{") or not folder:
            hp = path(p)
            out[p] = [s.getPath().toString() for s in hp.getFileSystem(conf).globStatus(hp) or []]
            continue
        if folder not in folders:
            hp = path(folder)
            fs = hp.getFileSystem(conf)
            listed = fs.listStatus(hp) if fs.exists(hp) else []
            folders[folder] = {s.getPath().getName(): s.getPath().toString() for s in listed}
        found = folders[folder].get(name)
        out[p] = [found] if found else []
    return out


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Keep the paths (globs allowed) that match at least one file."""
    return [p for p, found in _matches(spark, paths).items() if found]


def expand_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Concrete paths behind ``paths`` (globs expanded, missing skipped)."""
    return [f for found in _matches(spark, paths).values() for f in found]


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names: strip, lower, blank → underscore."""
    return df.toDF(*[normalize_header_name(c) for c in df.columns])


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def select_present(df: DataFrame, cols: Sequence[str], absent_type: str = "double") -> DataFrame:
    """Project ``cols``; a column the input lacks becomes a typed NULL."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(absent_type).alias(c) for c in cols])


def scan_fuel_csv(
    spark: SparkSession, paths: Sequence[str], fuels: Sequence[str], on_bad: str = "raise", file_col: str | None = None
) -> DataFrame:
    """Monthly fuel-mix CSVs → (timestamp, fuels..., other NULL).

    The column layout may drift from file to file (padded headers, a fuel
    column added or dropped), so every line meets the header of its own file
    (the row with a ``Date`` and an ``Hour`` cell): one scan for all layouts, no
    job while the plan is built (``sources.lines``). Missing files are
    skipped; none gives an empty typed frame; a fuel absent from a file is
    NULL. A line of one filled cell is a note and left out. Any other row
    whose date or hour does not parse, or whose file has no such header, fails
    the query; with ``on_bad="drop"`` it is left out too. ``file_col`` names a
    column for the row's file.
    """
    fields = [T.StructField("timestamp", T.TimestampNTZType())]
    fields += [T.StructField(f, T.DoubleType()) for f in [*fuels, "other"]]
    fields += [T.StructField(file_col, T.StringType())] if file_col else []
    found = existing_paths(spark, paths)
    if not found:
        return empty_frame(spark, T.StructType(fields))
    rows = lines.scan_cells(spark, found)
    norm = lambda c: F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))  # noqa: E731  (S2 on cells)
    is_header = F.exists(lines.CELLS, lambda c: norm(c) == "date") & F.exists(lines.CELLS, lambda c: norm(c) == "hour")
    data = lines.with_headers(rows, norm, F.coalesce(is_header, F.lit(False)))
    filled = F.size(F.filter(lines.CELLS, lambda c: F.trim(c) != ""))
    data = data.where(filled != 0)
    date, hour = (F.trim(lines.cell(n)) for n in ("date", "hour"))
    ts = hour_ending_to_start(F.try_to_timestamp(date).cast("date"), hour.try_cast("int"))
    vals = [F.nullif(F.trim(lines.cell(f)), F.lit("")).cast("double").alias(f) for f in fuels]
    if on_bad == "raise":
        line = F.concat(F.lit("no date and hour in "), F.col(lines.FILE), F.lit(": "), F.concat_ws(",", lines.CELLS))
        ts = F.coalesce(ts, F.when(filled > 1, F.raise_error(line).cast("timestamp_ntz")))
    named = [F.col(lines.FILE).alias(file_col)] if file_col else []
    out = data.select(ts.alias("timestamp"), *vals, F.lit(None).cast("double").alias("other"), *named)
    return out.filter(F.col("timestamp").isNotNull())


def plan_months(start: dt.date, end: dt.date) -> list[dt.date]:
    """First days of the months from ``start``'s month to ``end`` inclusive (S3).
    Driver-side metadata (one entry per month), used to name landing files."""
    cur = dt.date(start.year, start.month, 1)
    out = []
    while cur <= end:
        out.append(cur)
        cur = dt.date(cur.year + 1, 1, 1) if cur.month == 12 else dt.date(cur.year, cur.month + 1, 1)
    return out


def month_file_paths(root: str, start: dt.date, end: dt.date, pattern: str = "{y}{m:02d}.csv") -> list[str]:
    return [f"{root.rstrip('/')}/" + pattern.format(y=d.year, m=d.month) for d in plan_months(start, end)]


def month_sequence(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Distributed S3/F20: per group, every month from the first to the last
    month of ``ts``, with the next month's first day and a file label."""
    bounds = df.groupBy(*by).agg(F.trunc(F.min(ts).cast("date"), "MM").alias("_lo"), F.trunc(F.max(ts).cast("date"), "MM").alias("_hi"))
    months = bounds.select(*by, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return months.select(
        *by,
        "month",
        F.add_months(F.col("month"), 1).alias("next_month"),
        F.concat(F.date_format("month", "yyyyMM"), F.lit(".csv")).alias("file_name"),
    )


def drop_quirks(df: DataFrame, year: int | None) -> DataFrame:
    """Drop the per-year junk column if present."""
    col = QUIRK_COLUMNS.get(year) if year is not None else None
    return df.drop(col) if col and col in df.columns else df


def scan_plant_wide(df: DataFrame, year: int | None = None) -> DataFrame:
    """Plant-level wide table (landed as CSV/Parquet): quirk drop, ``Date``/``Hour``
    renamed to DATE/HOUR, rows without DATE dropped, hour-starting timestamp (S6)."""
    d = drop_quirks(df, year).withColumnsRenamed({"Date": "DATE", "Hour": "HOUR"})
    d = d.filter(F.col("DATE").isNotNull())
    ts = hour_ending_to_start(F.col("DATE"), F.col("HOUR"))
    return d.withColumn("timestamp", ts).drop("DATE", "HOUR")


def label_from_path(suffix: str = ".csv") -> Column:
    """``…/Tiered%20rates.csv`` → ``Tiered rates`` from the file name."""
    name = F.url_decode(F.col("_metadata.file_name"))
    return F.regexp_extract(name, r"^(.*)" + suffix.replace(".", r"\.") + "$", 1)


def scan_hist_csv(
    spark: SparkSession,
    paths: Sequence[str],
    index: str = "timestamp",
    label: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame | None:
    """Historical wide CSVs whose first, unnamed column is the index (S9):
    the first column is renamed to ``index`` and other headers stripped; with
    ``label`` a column derived from the file name is added (S10).

    All files are one scan, each line under its own file's header
    (``sources.lines``); a column that a file lacks is NULL, cells beyond the
    header are left out. ``columns`` names the value columns; without it they
    are read from the headers, which takes one job while the plan is built.
    ``_row`` orders the rows by file name, then by position, for first-wins
    dedupes (A10, U2). No file gives None."""
    found = expand_paths(spark, paths)
    if not found:
        return None
    rows = lines.scan_cells(spark, found)
    if columns is None:
        columns = _header_names(rows)
    data = lines.with_headers(rows, F.trim)
    order = F.struct(F.col(lines.FILE).alias("file"), F.col(f"{lines.POS}.start").alias("start"), F.col(f"{lines.POS}.line").alias("pos"))
    return data.select(
        F.try_element_at(lines.CELLS, F.lit(1)).alias(index),
        *[lines.cell(c).alias(c) for c in columns],
        *([lines.file_name().alias(label)] if label else []),
        order.alias(ROW),
    )


def _header_names(rows: DataFrame) -> list[str]:
    """The names of all headers but the index, in the order of the files: one
    row for each layout comes to the driver."""
    headers = rows.groupBy(lines.FILE).agg(F.min_by(lines.CELLS, lines.POS).alias("names"))
    layouts = headers.groupBy("names").agg(F.min(lines.FILE).alias("file")).orderBy("file")
    names = (n.strip() for r in layouts.select(F.slice("names", 2, 1 << 30).alias("n")).collect() for n in r["n"] if n)
    return [n for n in dict.fromkeys(names) if n]


def scan_generator_xml(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Generator reference XML → (name_key, fuel, report_date, file, pos).

    Namespaced documents are read with ``rowTag=Generator``; text is trimmed
    by the reader. The report date comes from the file name (``…_YYYYMMDD.xml``).
    """
    found = existing_paths(spark, paths)
    schema = "name_key string, fuel string, report_date date, file string, pos bigint"
    if not found:
        return spark.createDataFrame([], schema)
    raw = spark.read.format("xml").option("rowTag", "Generator").load(found)
    if "GeneratorName" not in raw.columns or "FuelType" not in raw.columns:
        return spark.createDataFrame([], schema)
    fname = F.col("_metadata.file_name")
    return raw.select(
        F.upper(F.trim(F.col("GeneratorName").cast("string"))).alias("name_key"),
        F.lower(F.col("FuelType").cast("string")).alias("fuel"),
        F.to_date(F.regexp_extract(fname, r"(\d{8})", 1), "yyyyMMdd").alias("report_date"),
        fname.alias("file"),
        F.monotonically_increasing_id().alias("pos"),
    )


def latest_nonempty_mapping(gens: DataFrame, asof: dt.date | None = None, days: int = 9) -> DataFrame:
    """The mapping from the newest report that has generators (S8): a scalar
    max over report dates, then a filter — no per-file driver loop. With
    ``asof``, only reports from the ``days`` days before it count (the source
    tries yesterday back to nine days ago); none → an empty mapping.
    Of duplicate names inside one report the last one wins."""
    if asof is not None:
        lo = F.date_sub(F.lit(asof).cast("date"), days)
        gens = gens.filter((F.col("report_date") >= lo) & (F.col("report_date") < F.lit(asof).cast("date")))
    newest = gens.select(F.max("report_date")).scalar()
    m = gens.filter(F.col("report_date") == newest)
    return m.groupBy(F.col("name_key").alias("_mkey")).agg(F.max_by("fuel", "pos").alias("_mclass"))


def scan_generation(
    spark: SparkSession,
    plant_paths: dict[int | str, Sequence[str]],
    csv_root: str,
    start: dt.date,
    end: dt.date,
    mapping: DataFrame | None = None,
) -> DataFrame:
    """Three-era generation scan clipped to [start, end] (S4):

    * yearly plant-level tables up to 2018 and the Jan–Apr 2019 table
      (``plant_paths``: year or label → landed CSV paths), aggregated to fuels
      with the generator dictionary (``mapping``) and the name rules;
    * monthly fuel-mix CSVs from May 2019 (``csv_root/YYYYMM.csv``).

    Each era is a separate scan with its own date clip, so that a workbook row
    from May 2019 on does not repeat one of the CSVs, and years outside the
    range are not read; the union is by name,
    a fuel absent from an era is NULL.
    """
    from ampere.operators.reshape import plants_to_fuels
    from ampere.schemas import FUELS

    parts: list[DataFrame] = []
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end + dt.timedelta(days=1)).cast("timestamp_ntz")
    csv_era = F.lit(ERA_CSV_START).cast("timestamp_ntz")
    if start < ERA_CSV_START:
        for year, paths in plant_paths.items():
            if isinstance(year, int) and not start.year <= year <= end.year:
                continue
            found = existing_paths(spark, paths)
            if not found:
                continue
            raw = spark.read.option("header", True).csv(found)
            wide = scan_plant_wide(raw, year if isinstance(year, int) else None)
            wide = wide.filter((F.col("timestamp") >= lo) & (F.col("timestamp") < F.least(hi, csv_era)))
            fuels = plants_to_fuels(wide, ["timestamp"], mapping, total_col="TOTAL", classes=FUELS).drop("_row")
            parts.append(fuels)
    csv_from = max(start, ERA_CSV_START)
    if csv_from <= end:
        paths = month_file_paths(csv_root, csv_from, end)
        csv = scan_fuel_csv(spark, paths, [f for f in FUELS if f != "other"] + ["total"])
        parts.append(csv.filter((F.col("timestamp") >= lo) & (F.col("timestamp") < hi)))
    if not parts:
        from ampere.schemas import GENERATION_RAW

        return empty_frame(spark, GENERATION_RAW)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet mart scan for the serving layer."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def table_or_empty(spark: SparkSession, path: str | None, schema: T.StructType | None) -> DataFrame | None:
    """The table at ``path``, also one that was declared but holds no rows yet;
    when absent, an empty frame of ``schema``, or None where no schema is
    given (S14)."""
    from ampere.sinks.tables import read_table, table_exists

    if path is not None and table_exists(spark, path):
        return read_table(spark, path)
    return None if schema is None else empty_frame(spark, schema)


def typed_empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return empty_frame(spark, schema)
