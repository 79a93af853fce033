"""Order and delivery analytics on Spark DataFrames."""
