"""The pipeline is its stages, one after another, on what the one before kept."""

import os

import pytest

import corpus_pipeline as P
from ampere.llm import neardup, packing, pii, quality, substring

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_stages_in_order(spark):
    assert [f for _, f in P.STAGES] == [quality.stage, neardup.stage, substring.stage, pii.stage, packing.stage]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.count()]
    for _, stage in P.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] >= seen[3] == seen[4] > 0
    want = docs.select("doc_id").distinct().count()
    out = P.run(spark, SF)
    assert out.select("doc_id").distinct().count() == want and set(out.columns) == set(packing.NAMES)
