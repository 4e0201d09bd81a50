"""Matching, text-quality and model-audit operators on Spark DataFrames."""
