"""DataFrame operators: each takes DataFrames + column names, returns a plan."""
