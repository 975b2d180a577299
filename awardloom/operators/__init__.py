"""Operators: DataFrame in, DataFrame out, nothing collected."""
