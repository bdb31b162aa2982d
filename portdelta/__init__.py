"""Network counter analytics on Spark DataFrames."""
