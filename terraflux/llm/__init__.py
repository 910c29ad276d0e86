"""Training-data operators: deduplication, scoring, search and mixing of text corpora.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which belongs to it) imports it.
"""
