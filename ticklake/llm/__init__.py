"""Operators for large training-data pipelines (deduplication, scanning,
language identification, tokenisation and packing).

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py``
imports it; ``__spark_entry__`` adds its queries when it is present.
"""
