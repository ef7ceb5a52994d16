"""Registered queries of this package, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ampere.llm import alignment, bpe, embeddings, fingerprints, maintext, neardup, negatives, packing, pii, quality, substring, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, op: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    query.__name__, query.__doc__ = op.__name__, op.__doc__
    return query


def _labelled(op: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

    query.__name__, query.__doc__ = op.__name__, op.__doc__
    return query


QUERIES: dict[str, Query] = {
    "op1_fingerprints": _over("documents", fingerprints.op1_fingerprints),
    "op2_quality": _labelled(quality.op2_quality),
    "op3_substring_dedup": _over("documents", substring.op3_substring_dedup),
    "op4_byte_bpe": _over("documents", bpe.op4_byte_bpe),
    "op5_toxicity": _labelled(toxicity.op5_toxicity),
    "op6_embedding_neardup": _over("embeddings", embeddings.op6_embedding_neardup),
    "op7_url_filter": _over("pages", urls.op7_url_filter),
    "op8_packing": _over("documents", packing.op8_packing),
    "op9_minhash_neardup": _over("documents", neardup.op9_minhash_neardup),
    "op10_pii_surrogates": _over("documents", pii.op10_pii_surrogates),
    "op11_main_text": _over("pages", maintext.op11_main_text),
    "op12_alignment": _over("documents", alignment.op12_alignment),
    "op13_hard_negatives": _over("embeddings", negatives.op13_hard_negatives),
}

#: The other operators hold a model, a sketch, a tokenizer or keyed draws, and
#: are tested against brute-force versions instead.
ORACLE: dict[str, str] = {
    "op3_substring_dedup": substring.ORACLE,
    "op6_embedding_neardup": embeddings.ORACLE,
    "op11_main_text": maintext.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
