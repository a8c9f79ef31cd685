"""Operators for preparing training data: formatting, packing, search, joins, mixing, dedup, shards.

Nothing outside this folder imports it.
"""
