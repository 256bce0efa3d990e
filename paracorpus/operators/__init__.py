"""Operators of the parallel-corpus engine."""
