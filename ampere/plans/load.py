"""One source load as users run it: freshness gate → schema contract → keyed
merge (or full refresh) into the raw table → run-log record.

The gate and the record are the only driver-side decisions; each reads one
bounded row (the freshness report of one table)."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.operators.quality import enforce_schema, freshness
from ampere.schemas import TableSpec
from ampere.sinks import key_index
from ampere.sinks.tables import log_run, read_table, replace_table, table_exists, upsert_table

# Freshness thresholds per source, in seconds (1 h / 1 d / 7 d).
FRESHNESS_SECONDS = {"readings": 3600.0, "generation": 86400.0, "rates": 604800.0}


def is_fresh(spark: SparkSession, spec: TableSpec, path: str, source: str, asof: dt.datetime, partition_by=()) -> bool:
    """Strictly younger than the source's threshold; unknown source, missing
    or empty table → not fresh. Where the table has a key index that begins
    with the cursor, its newest row is known without a scan of the data."""
    if source not in FRESHNESS_SECONDS or not table_exists(spark, path):
        return False
    rows = read_table(spark, path)
    if partition_by and spec.keys[0] == spec.cursor and key_index.has_index(spark, path):
        newest = key_index.greatest(spark, path, spec.cursor, partition_by)
        kind = rows.schema[spec.cursor].dataType
        rows = spark.createDataFrame([(newest,)], T.StructType([T.StructField(spec.cursor, kind)]))
    report = freshness({source: (rows, spec.cursor, FRESHNESS_SECONDS[source])}, asof)
    return bool(report.select("is_fresh").first()[0])


def load_batch(
    spark: SparkSession,
    spec: TableSpec,
    batch: DataFrame,
    path: str,
    source: str,
    run_log: str | None = None,
    full_refresh: bool = False,
    asof: dt.datetime | None = None,
    partition_by=(),
) -> str:
    """Returns the run status: ``skipped`` (fresh), ``success`` or raises
    after logging ``failed``."""
    asof = asof or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_id = uuid.uuid4().hex
    t0 = time.perf_counter()
    if not full_refresh and is_fresh(spark, spec, path, source, asof, partition_by):
        if run_log:
            log_run(spark, run_log, run_id, source, "skipped", 0, time.perf_counter() - t0, timestamp=asof)
        return "skipped"
    try:
        data = enforce_schema(batch, spec.schema, mode="freeze")
        if partition_by:
            data = data.withColumn(partition_by[0], F.date_format(F.col(spec.cursor), "yyyy-MM"))
        if full_refresh:
            replace_table(data, path, partition_by)
        else:
            upsert_table(spark, path, data, list(spec.keys), partition_by)
        status, err = "success", None
    except Exception as e:  # noqa: BLE001 — recorded, then re-raised
        status, err = "failed", str(e)
        if run_log:
            log_run(spark, run_log, run_id, source, status, None, time.perf_counter() - t0, err, timestamp=asof)
        raise
    if run_log:
        log_run(spark, run_log, run_id, source, status, None, time.perf_counter() - t0, timestamp=asof)
    return status
