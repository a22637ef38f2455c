"""Live forms of the reports on Structured Streaming."""
