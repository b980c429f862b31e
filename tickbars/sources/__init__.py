"""Readers of raw tick files and the Parquet store of results."""
