"""Training-data operators: filtering, extraction, deduplication, scanning, search, mixing and packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
