"""Operators for training-data pipelines: filters, joins, dedup, packing, tokenisation.

Nothing else in the library imports this subpackage. ``registry`` holds its
queries and their DuckDB SQL.
"""
