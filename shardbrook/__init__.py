"""Sharded record logs on Spark: reading, progress, metrics and reports."""
