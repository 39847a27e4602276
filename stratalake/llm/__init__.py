"""Operators for preparing training data, each a function over DataFrames."""
