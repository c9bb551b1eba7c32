"""Repository-stream analytics written as Spark DataFrame and Structured Streaming jobs."""
