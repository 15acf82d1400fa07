"""Road-traffic event analytics as plain Spark DataFrame and Structured Streaming jobs."""
