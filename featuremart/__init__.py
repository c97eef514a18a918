"""Batch feature engineering for subscriber and account data on Spark DataFrames."""
