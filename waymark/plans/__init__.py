"""Whole jobs: DataFrames in, DataFrames out."""
