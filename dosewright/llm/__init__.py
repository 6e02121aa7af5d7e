"""Operators of a training-data pipeline: deduplication, quality, language, mixing, packing.

Nothing outside this subpackage imports it. Their registered queries are in
:mod:`dosewright.llm.queries`.
"""
