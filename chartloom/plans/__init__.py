"""Whole runs put together from operators; each takes and gives DataFrames."""
