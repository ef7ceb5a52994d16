"""Key-to-partition index of a partitioned Parquet table.

Where a table's partitions do not follow from its keys, an upsert has to know
in which partition a key is stored. The index tells which partitions cannot
hold any key of a batch, so that the others alone are read. For each partition
it keeps, in the folder ``_keys`` next to the data,

* the least and the greatest value of the first key column, and
* a Bloom filter of all keys: bitmaps of 32,768 bits, one for each bucket of
  keys, about ten bits a key; and
* the names of the data files it was made from. A partition whose files are
  others today (written by someone else, or appended to) counts as one that
  may hold every key until ``refresh`` has read it.

Everything is built and tested with SQL functions; bitmaps have a partial
aggregate before the shuffle. The driver holds the names of files and
partitions, as it does for any scan of the table.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_keys"
BITS = 1 << 15
BITS_PER_KEY = 10
HASHES = 4
LEAST_BUCKETS = 8
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

Partition = tuple[str | None, ...]


def _names(partition_by: Sequence[str]) -> str:
    """A pattern with the ``name=value`` folders of a data file as its group."""
    return "/((?:" + "/".join(re.escape(c) + "=[^/]*" for c in partition_by) + "))/[^/]*$"


def partition_files(spark: SparkSession, path: str, partition_by: Sequence[str]) -> dict[str, str]:
    """Partition folders and a digest of the names of their files, from one
    (distributed) listing; a file name is never used twice."""
    found: dict[str, list[str]] = defaultdict(list)
    pattern = re.compile(_names(partition_by))
    for file in spark.read.parquet(path).inputFiles():
        m = pattern.search(file)
        if m:
            found[m.group(1)].append(file.rsplit("/", 1)[1])
    return {part: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for part, files in found.items()}


def values(part: str) -> Partition:
    """``a=1/b=x`` → the partition values."""
    found = (unquote(unquote(folder.partition("=")[2])) for folder in part.split("/"))
    return tuple(None if v == NULL_PARTITION else v for v in found)


def _hashes(keys: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes of a key."""
    cols = [F.col(f"`{k}`") for k in keys]
    return [F.xxhash64(*cols).alias("_h"), F.xxhash64(F.lit("bucket"), *cols).alias("_g")]


def _positions() -> list[Column]:
    """The bits of a key in its bucket's bitmap: 15 bits of the hash each."""
    return [F.shiftright("_h", 15 * i).bitwiseAND(F.lit(BITS - 1)) for i in range(HASHES)]


def _is_set(bits: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(position, F.lit(8)).cast("int"))) != 0


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    return _stored(spark, f"{path.rstrip('/')}/{FOLDER}")


def _stored(spark: SparkSession, folder: str) -> DataFrame | None:
    from ampere.sinks.tables import path_exists

    return spark.read.option("basePath", folder).parquet(folder) if path_exists(spark, folder) else None


def has_index(spark: SparkSession, path: str) -> bool:
    from ampere.sinks.tables import path_exists

    return path_exists(spark, f"{path.rstrip('/')}/{FOLDER}")


def part_of(partition_by: Sequence[str]) -> Column:
    """The ``name=value`` folders of a scanned row's file."""
    return F.regexp_extract(F.col("_metadata.file_path"), _names(partition_by), 1)


def known(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(files.items()), "part string, files string")


def fresh_in(spark: SparkSession, folder: str, files: dict[str, str]) -> set[str]:
    """The partitions of which ``folder`` holds rows made from the files they have now."""
    stored = _stored(spark, folder)
    if stored is None:
        return set()
    rows = stored.select("part", "files").distinct().join(known(spark, files), ["part", "files"], "left_semi").select("part").distinct()
    return {r["part"] for r in rows.collect()}


def fresh_parts(spark: SparkSession, path: str, files: dict[str, str]) -> set[str]:
    """The partitions whose index was made from the files they have now."""
    return fresh_in(spark, f"{path.rstrip('/')}/{FOLDER}", files)


def greatest(spark: SparkSession, path: str, key: str, partition_by: Sequence[str]):
    """The greatest value of the index's first key column, from the index; only
    partitions without an index of their present files are read (A4, I2, J6)."""
    from ampere.sinks.tables import touched_partitions

    files = partition_files(spark, path, partition_by)
    fresh = fresh_parts(spark, path, files)
    found = []
    if fresh:
        rows = _index(spark, path).join(known(spark, files), ["part", "files"], "left_semi")
        found.append(rows.agg(F.max("hi").alias("m")))
    stale = [values(p) for p in sorted(set(files) - fresh)]
    if stale:
        found.append(touched_partitions(spark.read.parquet(path), stale, partition_by).agg(F.max(key).alias("m")))
    return max((r["m"] for df in found for r in df.collect() if r["m"] is not None), default=None)


def refresh(spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> list[Partition]:
    """Index the partitions that have no index or an outdated one; returns them.
    Only their keys are read."""
    from ampere.sinks.tables import touched_partitions

    files = partition_files(spark, path, partition_by)
    stale = sorted(set(files) - fresh_parts(spark, path, files))
    if not stale:
        return []
    table = touched_partitions(spark.read.parquet(path), [values(p) for p in stale], partition_by)
    rows = table.select(part_of(partition_by).alias("part"), F.col(f"`{keys[0]}`").alias("_first"), *_hashes(keys))
    size = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("_first").alias("lo"), F.max("_first").alias("hi"))
    doublings = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("n") * F.lit(BITS_PER_KEY / BITS / LEAST_BUCKETS))).cast("double"))
    size = size.select("part", "lo", "hi", F.call_function("shiftleft", F.lit(LEAST_BUCKETS), doublings.cast("int")).cast("bigint").alias("buckets"))
    size = size.join(known(spark, files), "part")
    bits = rows.join(size, "part").select(
        "part", "files", "lo", "hi", "buckets", F.pmod("_g", "buckets").alias("bucket"), F.explode(F.array(*_positions())).alias("_bit")
    )
    bits = bits.groupBy("part", "files", "lo", "hi", "buckets", "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))
    out = bits.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part")
    out.parquet(f"{path.rstrip('/')}/{FOLDER}")
    return [values(p) for p in stale]


def may_hold(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> list[Partition]:
    """The partitions of the table that may hold a key of ``batch``: those the
    index does not rule out. Keys with a null match no stored key."""
    files = partition_files(spark, path, partition_by)
    fresh = fresh_parts(spark, path, files)
    unknown = [values(p) for p in sorted(set(files) - fresh)]
    if not fresh:
        return unknown
    index = _index(spark, path).join(known(spark, files), ["part", "files"], "left_semi")
    stored = spark.read.parquet(path).schema  # a key hashes as the type it is stored in
    typed = batch.select(*[F.col(f"`{k}`").cast(stored[k].dataType).alias(k) for k in keys])
    wanted = typed.where(F.col(f"`{keys[0]}`").isNotNull()).select(F.col(f"`{keys[0]}`").alias("_first"), *_hashes(keys))
    low, high = wanted.select(F.min("_first")).scalar(), wanted.select(F.max("_first")).scalar()
    index = index.where((F.col("hi") >= low) & (F.col("lo") <= high))
    sizes = [r["buckets"] for r in index.select("buckets").distinct().collect()]  # powers of two: a few dozen at most
    if not sizes:
        return unknown
    probe = wanted.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("buckets")).withColumn("bucket", F.pmod("_g", "buckets"))
    hit = probe.join(index, ["buckets", "bucket"]).where(F.col("_first").between(F.col("lo"), F.col("hi")))
    for position in _positions():
        hit = hit.where(_is_set("bits", position))
    return unknown + sorted((values(r["part"]) for r in hit.select("part").distinct().collect()), key=str)
