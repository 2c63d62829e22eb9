"""The batch rules as Structured Streaming jobs."""
