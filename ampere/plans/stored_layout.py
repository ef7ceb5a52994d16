"""Facts and staged readings stored by the hour.

Tables that are joined on the hour again and again are stored in buckets of
the hour, sorted within them. A full outer join of two tables with the same
buckets then needs no exchange and reads each of them once, and so do
dedupes and aggregates by the hour. The price is that a bucket is one task, so
the number of buckets is chosen from the size of the table, and a table in
which one hour may be very hot is better joined by ``hourly_full_outer``'s split
strategy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.functions.time import trunc_ntz
from ampere.plans.marts import LIVE_COLS
from ampere.schemas import READING_SOURCES

#: Bytes of a bucket that one task reads and sorts with ease.
BUCKET_BYTES = 256 << 20


def buckets_for(table_bytes: int, least: int = 8) -> int:
    """A power of two, so that tables of unlike size still line up."""
    n = max(least, -(-table_bytes // BUCKET_BYTES))
    return 1 << (n - 1).bit_length()


def save_by_hour(df: DataFrame, name: str, path: str, buckets: int, hour: str = "hour") -> DataFrame:
    """Write ``df`` as the table ``name`` at ``path``, in buckets of ``hour``."""
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, hour).sortBy(hour)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def attach_by_hour(spark: SparkSession, name: str, path: str, schema: str, buckets: int, hour: str = "hour") -> DataFrame:
    """Declare files written by ``save_by_hour`` as a table of this session."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({hour}) SORTED BY ({hour}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def readings_by_hour(stg_readings: DataFrame) -> DataFrame:
    """Staged readings with the hour they join on as a column of their own."""
    return stg_readings.withColumn("hour", trunc_ntz("hour", "ts"))


def fct_intensity_stored(
    fct_generation: DataFrame, readings: DataFrame, flags: tuple[str, str] = ("has_generation", "has_readings")
) -> DataFrame:
    """As ``marts.fct_intensity``, over two tables stored by the hour: one full
    outer sort-merge join without an exchange, each table read once."""
    fuels = [f"{f}_mw" for f in ["nuclear", "gas", "hydro", "wind", "solar", "biofuel"]] + ["total_mw", "clean_pct"]
    by_source = [f"{s}_{kind}" for s in READING_SOURCES for kind in ("mw", "pct")]
    left = fct_generation.select("hour", *fuels, F.col("hour").isNotNull().alias("_l"))
    right = readings.select(
        F.col("hour").alias("_rh"), *LIVE_COLS, *[F.col(c).alias(f"gw_{c}") for c in by_source], F.col("ts").isNotNull().alias("_r")
    )
    joined = left.join(right, F.col("hour") == F.col("_rh"), "full_outer")
    return joined.select(
        F.coalesce("hour", "_rh").alias("hour"), *fuels, *LIVE_COLS, *[f"gw_{c}" for c in by_source],
        F.coalesce("_l", F.lit(False)).alias(flags[0]), F.coalesce("_r", F.lit(False)).alias(flags[1]),
    )
