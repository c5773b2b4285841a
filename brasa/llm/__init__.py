"""Operators of a training-data pipeline: near-dedup, scans, archives, tokens, packing.

Nothing outside this subpackage imports it.  ``registry.QUERIES`` and ``registry.ORACLES`` hold the queries.
"""
