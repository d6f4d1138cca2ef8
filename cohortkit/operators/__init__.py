"""Business operators: each takes DataFrames and RunParams and returns a lazy DataFrame."""
