"""Banner performance and serving on Spark DataFrames."""
