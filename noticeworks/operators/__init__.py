"""DataFrame operators: every operator takes DataFrames and returns a DataFrame."""
