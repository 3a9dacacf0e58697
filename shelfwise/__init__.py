"""Retail panel analytics on Spark DataFrames."""
