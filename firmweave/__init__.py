"""Company entity resolution on Spark DataFrames."""
