"""Metrics: each function maps DataFrames to a DataFrame."""
