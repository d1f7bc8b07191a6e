"""Training-data operators: token counts, language, dedup, quality, mixing, packing, search.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
