"""Consistency rules, search indexes and reconciliation jobs for large catalogues, on Spark DataFrames."""
