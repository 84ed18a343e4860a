"""DataFrame-in, DataFrame-out operators. Column names are parameters."""
