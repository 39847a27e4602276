"""Column functions: no DataFrames, no actions."""
