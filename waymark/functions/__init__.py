"""Scalar functions: geography as Column expressions and as plain Python."""
