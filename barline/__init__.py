"""Daily stock and option bar analytics on Spark DataFrames."""
