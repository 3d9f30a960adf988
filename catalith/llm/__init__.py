"""Training-data operators. Nothing outside this folder imports it; it can be deleted together with ``tests/llm`` and ``corpus_pipeline.py``."""
