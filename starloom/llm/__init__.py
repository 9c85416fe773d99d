"""Operators of a training-data pipeline (ten operators; see README).

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; Python runs inside Arrow batches where built-in functions cannot
express the work.
"""
