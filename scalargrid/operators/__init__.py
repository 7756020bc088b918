"""DataFrame operators: DataFrames in, lazy DataFrames out."""
