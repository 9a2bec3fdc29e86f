"""Operators of a training-data pipeline: scoring, mixing, packing, filtering, dedup, archives.

Nothing outside this subpackage imports it; the queries over it are in ``fleetsight.llm.queries``.
"""
