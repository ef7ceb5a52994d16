"""File-backed table maintenance on plain Parquet (K1–K5, K8).

There is no MERGE on plain Parquet, so a keyed upsert is:

1. read only the target partitions the batch touches, and those that hold one
   of its keys elsewhere (partition pruning; ``key_index`` rules out the rest);
2. compute the merged rows of those partitions (``keyed.upsert``);
3. write them to a staging folder next to the table (a finished job — if an
   executor is lost, Spark recomputes tasks, and a failed job leaves the
   target untouched);
4. re-read the staging folder and overwrite the target with dynamic
   partition overwrite, so untouched partitions stay as they are.

Step 3 is also what makes self-overwrite safe: the DataFrame written in step
4 no longer reads the target's files. Step 4 itself is not atomic: if the
driver is lost while it runs, the merged rows are still in the staging folder
next to the table, and writing them again completes the merge.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.operators.keyed import new_rows_absent, one_per_key, upsert
from ampere.operators.quality import enforce_schema
from ampere.sinks import key_index


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table exists when its folder holds a success marker, a declared
    schema or data."""
    if not path_exists(spark, path):
        return False
    fs, p = _fs(spark, path)
    return any(not f.getPath().getName().startswith(".") for f in fs.listStatus(p))


def _has_data(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether the table exists and holds data files."""
    return table_exists(spark, path) and _has_data(spark, path)


def _staging(path: str) -> str:
    return path.rstrip("/") + f".__staging-{uuid.uuid4().hex[:12]}"


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh (K2)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty table with ``schema`` when none exists (K3). A
    partitioned one has no folder to hold a file yet, so its schema is kept
    in ``_schema``, which readers of the data skip."""
    if table_exists(spark, path):
        return
    empty = spark.createDataFrame([], schema).write.mode("overwrite")
    empty.parquet(path.rstrip("/") + "/_schema" if partition_by else path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a table; a declared one without data has none, under its
    declared schema. A path that is a single file is read as it is."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if _has_data(spark, path):
        return r.parquet(path)
    declared = path.rstrip("/") + "/_schema"
    return r.parquet(declared if path_exists(spark, declared) else path)


def stored_partitions(spark: SparkSession, path: str, partition_by: Sequence[str]) -> list[tuple[str | None, ...]]:
    """The partitions of a table by its folders: metadata, no Spark job."""
    return [values for values, _ in _partition_folders(spark, path, partition_by)]


def _partition_folders(spark: SparkSession, path: str, partition_by: Sequence[str]) -> list[tuple[tuple[str | None, ...], str]]:
    from urllib.parse import unquote

    found = [((), path.rstrip("/"))]
    for c in partition_by:
        deeper = []
        for values, folder in found:
            fs, p = _fs(spark, folder)
            for f in fs.listStatus(p):
                name, _, value = f.getPath().getName().partition("=")
                if name == c:
                    value = None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)
                    deeper.append(((*values, value), f.getPath().toString()))
        found = deeper
    return found


def touched_partitions(target: DataFrame, touched: Sequence[tuple[str | None, ...]], partition_by: Sequence[str]) -> DataFrame:
    """Restrict ``target`` to some partitions by a filter on literals, so that
    the scan lists only their folders."""
    if len(partition_by) == 1:
        c = partition_by[0]
        cond = F.col(c).isin([F.lit(v).cast(target.schema[c].dataType) for (v,) in touched if v is not None])
        return target.filter(cond | F.col(c).isNull() if (None,) in touched else cond)
    cond = F.lit(False)
    for values in touched:
        term = F.lit(True)
        for c, v in zip(partition_by, values):
            term = term & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v).cast(target.schema[c].dataType))
        cond = cond | term
    return target.filter(cond)


class Merge(NamedTuple):
    """Partitions of the table whose keys were read, and that were rewritten."""

    read: list[tuple[str | None, ...]]
    written: list[tuple[str | None, ...]]


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    batch_order: Sequence | None = None,
    schema: T.StructType | None = None,
) -> Merge:
    """Keyed merge of ``batch`` into the Parquet table at ``path`` (K1).

    The first load goes through the same deduplication as later ones. The
    batch is computed once, into a staging table. Only the partitions that the
    batch touches are merged and rewritten, and with them those in which a key
    of the batch is stored although the batch has it in another one, so that
    the old row goes. Where the keys do not hold the partition columns, the
    key index says which partitions may be such; only their keys are read.
    Columns new in the batch are added, and are NULL in stored rows.
    """
    keys, partition_by = list(keys), list(partition_by)
    if schema is not None:
        batch = enforce_schema(batch, schema, mode="by_name")
    fresh = _staging(path)
    _write(one_per_key(batch, keys, batch_order), fresh, partition_by)
    batch = spark.read.schema(batch.schema).parquet(fresh).select(*batch.columns)
    moving = bool(partition_by) and not set(partition_by) <= set(keys)
    written = stored_partitions(spark, fresh, partition_by) if partition_by else []
    probed: list[tuple[str | None, ...]] = []
    stage = None
    if not table_exists(spark, path) or not _has_data(spark, path):
        _write(batch, path, partition_by)
    else:
        target = spark.read.parquet(path)
        if moving:
            probed = [p for p in key_index.may_hold(spark, path, batch, keys, partition_by) if p not in set(written)]
            if probed:
                stored = touched_partitions(target, probed, partition_by).join(batch.select(*keys), keys, "left_semi")
                stored = stored.select(*[F.col(c).cast("string") for c in partition_by]).distinct()
                written += [tuple(r) for r in stored.collect()]
        if partition_by:
            target = touched_partitions(target, written, partition_by)
        merged = upsert(target, batch, keys)
        stage = _staging(path)
        _write(merged, stage, partition_by)
        if _has_data(spark, stage):
            staged = spark.read.schema(merged.schema).parquet(stage).select(*merged.columns)
            _write(staged, path, partition_by, "dynamic" if partition_by else "static")
        if partition_by:  # a partition that has lost its last row
            drop_partitions(spark, path, partition_by, set(written) - set(stored_partitions(spark, stage, partition_by)))
    if moving:
        key_index.refresh(spark, path, keys, partition_by)
    for done in filter(None, (fresh, stage)):
        delete(spark, done)
    return Merge(sorted({*probed, *written}, key=str), sorted(written, key=str))


def drop_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], gone: set[tuple[str | None, ...]]) -> None:
    if gone:
        for values, folder in _partition_folders(spark, path, partition_by):
            if values in gone:
                delete(spark, folder)


def _write(df: DataFrame, path: str, partition_by: list[str], overwrite: str = "static") -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def insert_absent_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    batch_order: Sequence | None = None,
) -> None:
    """Create-if-absent, then append batch rows whose key is not stored yet,
    one per key, by column name (K3 + K4). Existing rows win; absent columns
    are NULL. An append only adds files, so the table may be read meanwhile."""
    ensure_table(spark, path, schema or batch.schema, partition_by)
    target = read_table(spark, path)
    new = new_rows_absent(target, one_per_key(batch, list(keys), batch_order), keys)
    aligned = new.select(
        *[(F.col(c) if c in new.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    )
    w = aligned.write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def export_sorted(df: DataFrame, path: str, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Globally ordered Parquet export (K5, L5): range partitioning + sort within
    partitions, so the files are in order without one task sorting everything.
    The row count comes from ``observe`` during the same write, no second scan.
    Returns the observed metrics (``{"rows": n}``)."""
    from pyspark.sql import Observation

    obs = Observation("export")
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # observe above the range exchange: the partitioner's sampling job runs
    # only the subtree below it, so rows are counted once, by the write
    out = df.repartitionByRange(n, *order).sortWithinPartitions(*order).observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(path)
    return obs.get


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    source: str,
    status: str,
    records_loaded: int | None = None,
    duration_seconds: float | None = None,
    error_message: str | None = None,
    git_commit: str | None = None,
    github_run_id: str | None = None,
    timestamp=None,
) -> None:
    """Append one run record to the run log (K8)."""
    import datetime as dt

    from ampere.schemas import RUN_LOG

    ts = timestamp or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = [(run_id, ts, source, status, error_message, records_loaded, duration_seconds, git_commit, github_run_id)]
    spark.createDataFrame(row, RUN_LOG).write.mode("append").parquet(path)
