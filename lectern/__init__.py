"""Layered member and exam analytics on Spark DataFrames."""
