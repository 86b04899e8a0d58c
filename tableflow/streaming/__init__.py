"""Change capture by cursor rounds and by Structured Streaming."""
