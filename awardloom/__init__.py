"""Federal award transaction analytics on Spark DataFrames."""
