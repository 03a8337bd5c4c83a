"""Set-oriented lodging analytics on PySpark DataFrames and Structured Streaming."""
