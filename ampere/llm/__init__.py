"""Operators of a training-data pipeline: fingerprints, quality, deduplication,
tokenisation, toxicity, URL rules, packing and personal data.

Nothing outside this package imports it; ``corpus_pipeline.py`` and the query
registry use it when it is present.
"""
