"""Long-running Structured Streaming queries."""
