"""Operators of a training-data pipeline, each taking and returning DataFrames.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
