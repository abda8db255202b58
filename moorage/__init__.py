"""Stationary-vessel analytics on Spark: DataFrames in, DataFrames out."""
