"""Training-data operators: extraction, tokenisation, near-duplicates, language, personal data, packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which counts as
part of it) imports it.
"""
