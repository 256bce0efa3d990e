"""Streaming of the parallel-corpus engine."""
