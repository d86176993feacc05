"""Marketplace-listings analytics on Spark DataFrames."""
