"""Batch operators: DataFrames of events in, DataFrames of metric or alert rows out."""
