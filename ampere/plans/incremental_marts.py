"""Marts kept up to date by change propagation (K6, M4, M5).

The hour facts are stored in partitions by month. A row of either fact follows
from the raw rows of its own hour alone: the newest generation row of that
hour and the readings within it. So a batch can only change the hours it has
rows in, and those months' partitions of both facts are built again from the
same months of the raw tables; nothing else is read or written. The result
equals a full rebuild, which is the same code over all months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.plans import staging
from ampere.plans.marts import fct_generation, fct_intensity
from ampere.schemas import GENERATION_RAW, READINGS_RAW
from ampere.sinks.tables import delete, drop_partitions, stored_partitions, table_exists, touched_partitions
from ampere.sources.files import table_or_empty

#: Partition of the stored facts and of the raw tables that are partitioned.
PART, RAW_PART = "part", "month"

Months = Sequence[str | None]


def touched_months(*batches: tuple[DataFrame, str]) -> list[str | None]:
    """The months (``yyyy-MM``) that batches have rows in: one row per month
    comes to the driver."""
    found: set[str | None] = set()
    for batch, ts in batches:
        months = batch.select(F.date_format(F.col(ts).cast("timestamp_ntz"), "yyyy-MM").alias("m")).distinct()
        found |= {r["m"] for r in months.collect()}
    return sorted(found, key=lambda m: m or "")


def in_months(df: DataFrame, ts: str, months: Months | None) -> DataFrame:
    """Rows of ``df`` in some months: by the partition column where the table
    has one, else by ranges that the scan can skip row groups with."""
    if months is None:
        return df
    if RAW_PART in df.columns and isinstance(df.schema[RAW_PART].dataType, T.StringType):
        return touched_partitions(df, [(m,) for m in months], [RAW_PART])
    keep = F.lit(False)
    for m in months:
        if m is None:
            keep = keep | F.col(ts).isNull()
            continue
        first = dt.datetime.strptime(m, "%Y-%m")
        beyond = dt.datetime(first.year + first.month // 12, first.month % 12 + 1, 1)
        low, high = (F.lit(x.isoformat(" ")).cast("timestamp_ntz") for x in (first, beyond))
        keep = keep | ((F.col(ts) >= low) & (F.col(ts) < high))
    return df.where(keep)


def _write(df: DataFrame, path: str, ts: str, months: Months | None) -> None:
    """Replace the partitions of ``months`` (None: all) by the rows of ``df``."""
    spark = df.sparkSession
    rows = df.withColumn(PART, F.date_format(ts, "yyyy-MM"))
    before = set(stored_partitions(spark, path, [PART])) if table_exists(spark, path) else set()
    out = rows.write.mode("overwrite").partitionBy(PART)
    if months is None or not before:
        out.option("partitionOverwriteMode", "static").parquet(path)
        return
    stage = f"{path.rstrip('/')}.__refresh"
    out.option("partitionOverwriteMode", "static").parquet(stage)
    kept = stored_partitions(spark, stage, [PART])
    if kept:
        staged = spark.read.schema(rows.schema).parquet(stage)
        staged.write.mode("overwrite").partitionBy(PART).option("partitionOverwriteMode", "dynamic").parquet(path)
    drop_partitions(spark, path, [PART], ({(m,) for m in months} & before) - set(kept))
    delete(spark, stage)


def refresh_marts(spark: SparkSession, raw_root: str, out_root: str, months: Months | None = None) -> dict[str, DataFrame]:
    """Build the month partitions ``months`` of both hour facts anew (None: all
    of them, the full rebuild) and return the stored facts.

    The readings are staged once, as a table of its own next to the facts.
    A missing raw table has no rows; months without any raw row lose their
    partition.
    """
    raw, out = raw_root.rstrip("/"), out_root.rstrip("/")

    def table(name: str, schema: T.StructType) -> DataFrame:
        return in_months(table_or_empty(spark, f"{raw}/{name}", schema), "timestamp", months)

    generation = staging.stg_generation(spark, table("generation_history", GENERATION_RAW), table("generation_live", GENERATION_RAW))
    readings = staging.stg_readings(spark, table("readings_history", READINGS_RAW), table("readings_live", READINGS_RAW))
    _write(fct_generation(generation), f"{out}/fct_generation", "hour", months)
    _write(readings, f"{out}/_stg_readings", "ts", months)

    def stored(name: str, some: Months | None = None) -> DataFrame:
        df = spark.read.option("basePath", f"{out}/{name}").parquet(f"{out}/{name}") if stored_partitions(spark, f"{out}/{name}", [PART]) else None
        if df is None:
            schema = (fct_generation(generation) if name == "fct_generation" else readings).schema
            return spark.createDataFrame([], schema)
        return (df if some is None else touched_partitions(df, [(m,) for m in some], [PART])).drop(PART)

    fact = fct_intensity(stored("fct_generation", months), stored("_stg_readings", months))
    _write(fact, f"{out}/fct_intensity", "hour", months)
    kept = {"fct_generation": stored("fct_generation")}
    if stored_partitions(spark, f"{out}/fct_intensity", [PART]):
        kept["fct_intensity"] = spark.read.parquet(f"{out}/fct_intensity").drop(PART)
    else:
        kept["fct_intensity"] = spark.createDataFrame([], fact.schema)
    for name, df in kept.items():
        df.createOrReplaceTempView(name)
    return kept


def refresh_after(spark: SparkSession, raw_root: str, out_root: str, *batches: tuple[DataFrame, str]) -> list[str | None]:
    """Propagate loaded batches (rows and their time column) to the marts;
    returns the months that were built."""
    months = touched_months(*batches)
    if months:
        refresh_marts(spark, raw_root, out_root, months)
    return months
