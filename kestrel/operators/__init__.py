"""Operators: DataFrame in, DataFrame (or fitted stage) out."""
