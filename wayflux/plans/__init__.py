"""Logical plans of the layers, each a function from DataFrames to DataFrames."""
