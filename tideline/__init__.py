"""tideline: change-stream analytics on Spark DataFrames and Structured Streaming."""
