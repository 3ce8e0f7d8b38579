"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames, names the columns it reads through parameters, reads no
other column of its input, and keeps one defined answer for nulls, empty
texts, ties, repeated rows and empty tables (stated in its docstring).
"""
