"""Operators: DataFrame in, DataFrame (or fitted model) out."""
