"""Operators of a training-data pipeline: tokens, chats, quality, packing, licences, duplicates, language, shards, toxicity.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
