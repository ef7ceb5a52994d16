"""Load ledger: which landed files a table was loaded from.

The ledger is a small Parquet table with a row for each file that was loaded
(path, length, time of change, rows). A load lists the landing folder once
(Spark's ``binaryFile`` source without its content, so the listing and the
file states are distributed), removes what the ledger knows by an anti join
on path, length and time, and reads what is left in one scan. So a second run
reads no old file, and a file that was changed is loaded again. The boundary
file, that of the month of the table's newest row, is always read again, for
it may still grow in place.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.sinks.tables import path_exists, table_exists

LEDGER = "path string, length bigint, modified timestamp, rows bigint, run_id string, loaded_at timestamp_ntz"


def landed(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``(path, length, modified)`` of the files in a folder that hold a byte at
    least; none if it is not there."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], LEDGER)


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The files that the ledger does not hold as they are now."""
    return files.join(ledger, ["path", "length", "modified"], "left_anti")


@dataclass
class Load:
    """What a load did: ``status`` is ``skipped``, ``success`` or ``nothing``."""

    status: str
    files: list[str] = field(default_factory=list)
    rows: int = 0


def load_landed(
    spark: SparkSession,
    folder: str,
    ledger: str,
    read: Callable[[list[str]], DataFrame],
    merge: Callable[[DataFrame], object],
    glob: str = "*",
    boundary: str | None = None,
    file_col: str = "_file",
    loaded_at: dt.datetime | None = None,
) -> Load:
    """List, read, merge, record.

    ``read`` gives the rows of some files with their file in ``file_col``;
    ``merge`` gets them without it. ``boundary`` is the beginning of the names
    of files that are read again although the ledger holds them. The ledger is
    written last: a load that fails before it is done again as a whole, which
    a keyed merge allows. The driver holds the names of the pending files.
    """
    files = landed(spark, folder, glob)
    todo = pending(files, read_ledger(spark, ledger))
    if boundary:
        name = F.regexp_extract("path", "[^/]*$", 0)
        todo = todo.unionByName(files.where(name.startswith(boundary))).distinct()
    todo = [tuple(r) for r in todo.orderBy("path").collect()]
    if not todo:
        return Load("nothing")
    batch = read([p for p, _, _ in todo])
    merge(batch.drop(file_col))
    counts = batch.groupBy(F.regexp_extract(file_col, "[^/]*$", 0).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    now = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    kind = "path string, length bigint, modified timestamp, run_id string, loaded_at timestamp_ntz"
    run = uuid.uuid4().hex
    rows = spark.createDataFrame([(*f, run, now) for f in todo], kind)
    rows = rows.join(counts, F.url_decode("name") == F.regexp_extract("path", "[^/]*$", 0), "left")
    rows = rows.select("path", "length", "modified", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "run_id", "loaded_at")
    rows.coalesce(1).write.mode("append").parquet(ledger)
    done = read_ledger(spark, ledger).where(F.col("run_id") == run).agg(F.sum("rows")).first()[0]
    return Load("success", [p for p, _, _ in todo], done)


def load_generation(
    spark: SparkSession,
    folder: str,
    table: str,
    ledger: str,
    fuels: Sequence[str],
    run_log: str | None = None,
    asof: dt.datetime | None = None,
    pattern: str = "%Y%m",
    full_refresh: bool = False,
) -> Load:
    """The whole incremental load of the monthly fuel-mix files (I1, S3, S5):
    freshness gate → cursor → pending month files → one scan → keyed merge into
    the month partitions → ledger and run log."""
    from ampere.operators.quality import enforce_schema
    from ampere.plans.load import is_fresh
    from ampere.schemas import GENERATION_RAW, GENERATION_SPEC
    from ampere.sinks import key_index
    from ampere.sinks.tables import has_rows, log_run, upsert_table
    from ampere.sources.files import scan_fuel_csv

    asof = asof or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    began = time.perf_counter()

    def record(status: str, rows: int | None, error: str | None = None) -> None:
        if run_log:
            log_run(spark, run_log, uuid.uuid4().hex, "generation", status, rows, time.perf_counter() - began, error, timestamp=asof)

    if not full_refresh and is_fresh(spark, GENERATION_SPEC, table, "generation", asof, ["month"]):
        record("skipped", 0)
        return Load("skipped")
    cursor = key_index.greatest(spark, table, "timestamp", ["month"]) if has_rows(spark, table) else None

    def read(paths: list[str]) -> DataFrame:
        return scan_fuel_csv(spark, paths, list(fuels), file_col="_file")

    def merge(batch: DataFrame) -> None:
        rows = enforce_schema(batch, GENERATION_RAW, mode="by_name")
        rows = rows.withColumn("month", F.date_format("timestamp", "yyyy-MM"))
        upsert_table(spark, table, rows, list(GENERATION_SPEC.keys), ["month"])

    try:
        done = load_landed(spark, folder, ledger, read, merge, "*.csv", cursor.strftime(pattern) if cursor else None, loaded_at=asof)
    except Exception as e:
        record("failed", None, str(e))
        raise
    record("success", done.rows)
    return done
