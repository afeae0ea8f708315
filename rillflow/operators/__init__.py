"""Batch operators on DataFrames."""
