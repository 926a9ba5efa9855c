"""Operators of a training-data pipeline (sharding, extraction, deduplication, mixing, packing, filters).

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it."""
