"""Access-governance analytics on Spark DataFrames."""
