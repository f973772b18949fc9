"""The lakehouse jobs, each a function from DataFrames to DataFrames."""
