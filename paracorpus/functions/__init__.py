"""Functions of the parallel-corpus engine."""
