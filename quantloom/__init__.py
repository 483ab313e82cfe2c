"""Keyed price-series analytics on Spark DataFrames."""
