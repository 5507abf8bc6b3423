"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it.  Every operator is a function over
DataFrames; the thin ``opN_*`` queries in :mod:`tallyframe.llm.queries` derive
their digest columns from the operators' results.
"""
