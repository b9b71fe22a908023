"""Monthly extract refinery built on Spark DataFrames."""
