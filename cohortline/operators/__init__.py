"""Batch operators: DataFrames in, DataFrame out."""
