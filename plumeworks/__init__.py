"""plumeworks: hourly environmental-monitoring analytics on Spark DataFrames."""
