"""Training-data pipeline operators (one module per operator).

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it; ``__spark_entry__`` adds its queries only when the folder is present.
"""
