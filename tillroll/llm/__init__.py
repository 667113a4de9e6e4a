"""Training-data operators: ten corpus operators, one module each, and their queries.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
