"""Operators: DataFrames in, one DataFrame out, nothing executed."""
