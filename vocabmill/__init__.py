"""Terminology-graph analytics on Spark DataFrames."""
