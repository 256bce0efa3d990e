"""Sources of the parallel-corpus engine."""
