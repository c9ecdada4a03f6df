"""ferry: move, check and version tabular data with Spark DataFrames."""
