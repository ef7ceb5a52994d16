"""Shared pieces: intermediate tables on shared storage, row identity and
connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A null doc_id sorts after every number.
NULL_ID = 2**63 - 1


#: What tokenizing operators keep in a Python worker between tasks: module and name.
_KEPT = (("packing", "_ENCODERS"), ("bpe", "_CODECS"), ("alignment", "_PAIRS"))


def forget_tokenizers() -> None:
    """Let go what a reused Python worker still holds from tokenizing operators.

    Their tables are worth keeping between the tasks of one stage, but the same
    worker may serve other stages afterwards, whose memory would come on top.
    Tasks that hold arrays of their own call this first.
    """
    for module, name in _KEPT:
        loaded = sys.modules.get(f"{__package__}.{module}")
        if loaded is not None and getattr(loaded, name):
            getattr(loaded, name).clear()
            gc.collect()
    release_memory()


def release_memory() -> None:
    """Give the system back what this process has freed.

    The C library and Arrow's pool both keep freed memory for later. A worker
    that is used again would hold what its largest earlier stage needed, and
    tokenizers leave many small pieces of which little fits a later stage.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


#: About so many bytes of rows go to a Python worker at once.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers a few MB at a time, however many they are.

    By Spark's default a batch takes 10,000 rows, of texts often a whole input
    split; an executor would hold it for each of its tasks, in the JVM and in
    the worker, and a worker that is used again keeps much of that memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Where the setting is absent, a local session gets a folder of its own; on
    a cluster its absence is an error, because executors would not see it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ampere-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; ``codec``
    is a denser compression than the session's, for tables that hold texts.

    This cuts the lineage, so a lost executor costs at most the running
    stage, and it keeps a table that several consumers need from being
    computed for each of them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, key, text)``: ``id`` is the doc_id (null: after all others) and
    ``key`` a hash of the text, so that rows which share a doc_id but not a
    text stay apart; rows that agree in both have the same result anyway."""
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(F.col(text)).alias("key"),
        F.col(text).alias("text"),
    )


def real_id(c: str = "id"):
    """The doc_id behind ``keyed_text``'s id."""
    return F.when(F.col(c) != NULL_ID, F.col(c))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(vertex, component)`` for every vertex of ``edges``, the component
    being its smallest vertex.

    Each round points every vertex at its smallest neighbour, follows the
    pointers to their roots (doubling the distance each time) and contracts
    the edges. A round at least halves the vertices that still have edges, so
    the rounds grow with the logarithm of their number. All steps are joins
    and aggregates with partial sums; vertices with many edges are split by
    the skew-join rule, as both sides of each join are tables.
    """
    edges = materialize(
        edges.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b"))
        .where("a < b").distinct(),
        "edges",
    )
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).unionByName(
            edges.select(F.col("b").alias("v"), F.col("a").alias("n"))
        )
        parent = materialize(
            both.groupBy("v").agg(F.min("n").alias("n")).select("v", F.least("v", "n").alias("p")), "parent"
        )
        while True:
            up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            jumped = materialize(
                parent.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p"), (F.col("pp") != F.col("p")).alias("moved")),
                "jump",
            )
            moved = not jumped.where("moved").isEmpty()
            parent = jumped.select("v", "p")
            if not moved:
                break
        if labels is None:
            labels = parent.select("v", F.col("p").alias("c"))
        else:
            step = parent.select(F.col("v").alias("c"), F.col("p").alias("q"))
            labels = materialize(
                labels.join(step, "c", "left").select("v", F.coalesce("q", "c").alias("c")), "labels"
            )
        pa = parent.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        pb = parent.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        edges = materialize(
            edges.join(pa, "a").join(pb, "b")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .where("a < b").distinct(),
            "edges",
        )
    if labels is None:
        schema = T.StructType([T.StructField("vertex", T.LongType()), T.StructField("component", T.LongType())])
        return edges.sparkSession.createDataFrame([], schema)
    return labels.select(F.col("v").alias("vertex"), F.col("c").alias("component"))
