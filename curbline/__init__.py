"""Trip-pickup analytics on Spark DataFrames and Structured Streaming."""
