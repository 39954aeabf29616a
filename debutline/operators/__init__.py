"""DataFrame operators: each function takes DataFrames and column names and returns a DataFrame."""
