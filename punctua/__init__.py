"""Time-series, mobility and trend analytics on Spark DataFrames."""
