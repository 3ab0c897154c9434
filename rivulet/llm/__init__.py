"""Operators for large-scale training-data pipelines.

Thirteen operators over documents, pages, vectors, conversations and benchmark items, each a
function on DataFrames, and the queries that apply them to the driver's
tables (``queries.py``). Nothing outside this subpackage imports it.
"""
