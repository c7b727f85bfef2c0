"""Batch analytics for two-sided event data on Spark DataFrames."""
