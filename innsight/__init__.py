"""Marketplace analytics on plain Spark DataFrames, SQL and Structured Streaming."""
