"""Roadway sensor analytics as Spark DataFrame and Structured Streaming jobs."""
