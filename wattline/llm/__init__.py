"""Operators for building training corpora: one module per operator.

Nothing outside this folder imports it. ``queries.py`` holds the thin
``opN_<name>`` queries over the given tables; the operators themselves take
DataFrames and return DataFrames.
"""
