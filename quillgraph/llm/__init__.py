"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it.  Every operator is a function from
DataFrames to DataFrames; the thin contract queries are in ``queries``.
"""
