"""Operators on DataFrames: reshape, join, aggregate, rank, prepare, model, measure."""
