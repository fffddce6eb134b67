"""Spark-first analytics over versioned, hierarchically organised document corpora."""
