"""Reusable analytics operators for Spark DataFrames."""
