"""Operators on DataFrames: predicates, full text, histograms, collapsing."""
