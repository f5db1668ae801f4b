"""Keyed, quality and serving operators on DataFrames."""
