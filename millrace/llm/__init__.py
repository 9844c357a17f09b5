"""Operators of large-scale training-data pipelines.

Nothing outside this folder imports it.  Every operator takes DataFrames, reads the
columns it names and returns a DataFrame.  Those that return documents carry all
their columns, and call what they add by names that the documents don't have.
"""
