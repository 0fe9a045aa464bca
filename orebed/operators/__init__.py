"""Operators: DataFrames in, DataFrames out, column names as arguments."""
