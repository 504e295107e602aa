"""The data products: each one a function from input DataFrames to its output."""
