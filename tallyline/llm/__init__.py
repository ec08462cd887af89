"""Operators for preparing training text: deduplication, scoring, filtering, mixing, encoding.

Nothing outside this package imports it. Every operator takes and returns DataFrames, runs its
core work in Spark tasks and states in its docstring what it does with nulls, empty and very long
texts, ties, repeated rows and empty tables.
"""
