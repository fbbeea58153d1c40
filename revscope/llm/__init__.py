"""Operators for training-data pipelines: packing, de-duplication, secret scans,
fingerprints, language ID, chat formatting, token files, toxicity, byte-level
BPE and Jaccard joins.

Nothing else in the library imports this subpackage.  Each operator takes and
returns DataFrames; the registered queries are in :mod:`revscope.llm.queries`.
"""
