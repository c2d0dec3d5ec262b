"""Spark-first market-data analytics: every operator maps DataFrames to a DataFrame."""
