"""Operators for preparing training data: each takes and returns DataFrames."""
