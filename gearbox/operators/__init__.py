"""Operators: DataFrame in, DataFrame (or bounded scalars) out."""
