"""Monthly river-network flow analytics on Spark DataFrames."""
