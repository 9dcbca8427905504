"""Training-data operators (WARC, PII, near-duplicates, packing, ...).

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it. General
helpers (the shared folder) come from the rest of the library.
"""
