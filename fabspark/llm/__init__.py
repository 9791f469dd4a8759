"""Training-data operators: each takes and returns DataFrames and is imported by nothing else in the package."""
