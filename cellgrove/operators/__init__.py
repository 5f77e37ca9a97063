"""Operators on DataFrames; none collects rows to the driver."""
