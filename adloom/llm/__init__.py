"""Operators for preparing training data, each a function of DataFrames."""
