"""The hourly jobs as Structured Streaming queries."""
