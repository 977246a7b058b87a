"""Operators for training-data pipelines: deduplication, packing, scoring, archives, extraction.

Nothing else in the library imports this package. Each module holds one operator with its
own general interface; :mod:`tipoff.llm.queries` derives the registered queries from them.
"""
