"""Operators of a large-scale training-data pipeline, as Spark jobs.

Nothing outside this package (and ``corpus_pipeline.py``) imports it; the
queries it registers are in :mod:`paysift.llm.queries`.
"""
