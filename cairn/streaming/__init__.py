"""The stateless shaping and the running totals as Structured Streaming."""
