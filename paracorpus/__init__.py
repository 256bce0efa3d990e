"""Spark-native parallel-corpus engine: DataFrame operators, sources, plans and metrics."""
