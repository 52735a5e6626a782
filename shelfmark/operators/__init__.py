"""Operators on DataFrames: cleaning, candidate pairs, vectors, scoring, reconciliation, boxes."""
