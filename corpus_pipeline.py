"""The corpus pipeline: quality, near-duplicates, repeated passages, personal
data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampere.llm import neardup, packing, pii, quality, substring
from ampere.llm.base import materialize

STAGES = [
    ("quality", quality.stage),
    ("minhash", neardup.stage),
    ("substring", substring.stage),
    ("pii", pii.stage),
    ("packing", packing.stage),
]

#: The quality model and the alignment have no SQL form; the stages are tested
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; each stage's rows are
    written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
