"""Operators for preparing training text: counting, packing, de-duplicating, scoring, rendering.

Nothing outside this folder imports it, except the guarded import in ``__spark_entry__.py``
and ``corpus_pipeline.py``.
"""
