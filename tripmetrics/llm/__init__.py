"""Operators of a training-data pipeline (documents, pages, embeddings).

Nothing outside this package, ``tests/llm`` and ``corpus_pipeline.py``
imports it.  Each module holds one operator; ``queries`` registers one thin
query per operator; ``common`` holds what several of them share.
"""
