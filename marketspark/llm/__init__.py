"""Operators for training-data pipelines over documents, vectors and chats.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
