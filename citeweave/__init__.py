"""Citation-corpus analytics on Spark DataFrames."""
