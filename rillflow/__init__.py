"""Event-stream analytics on Spark DataFrames and Structured Streaming."""
