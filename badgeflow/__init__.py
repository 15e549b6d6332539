"""Badge-access event pipeline on Spark DataFrames and Structured Streaming."""
