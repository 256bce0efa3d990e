"""Plans of the parallel-corpus engine."""
