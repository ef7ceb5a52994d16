"""Bounded samples of labelled documents for fitting a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``most`` documents of either label
    outside the held-out fold, picked by a hash of the doc_id. Rows without
    an id or a label of 0 or 1 teach nothing; of several labels of one id the
    largest counts, and of several texts the smallest.

    The picked ids are a table of at most ``2 * most`` rows, which is why
    they may be broadcast.
    """
    rows = (
        labels.select(F.col("doc_id").alias("__id"), F.col(f"`{label}`").cast("int").alias("__label"))
        .where("__id is not null and __label in (0, 1)").where(fold(F.col("__id")) != 0)
        .groupBy("__id").agg(F.max("__label").alias("__label"))
    )
    order = [F.xxhash64("__id"), F.col("__id")]
    picked = rows.where("__label = 0").orderBy(*order).limit(most).unionByName(
        rows.where("__label = 1").orderBy(*order).limit(most)
    )
    found = docs.select(F.col("doc_id").alias("__id"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    return (
        found.join(F.broadcast(picked), "__id").groupBy("__id").agg(F.min("__text").alias("text"), F.first("__label").alias("label"))
        .select(F.col("__id").alias("doc_id"), "text", "label")
    )
