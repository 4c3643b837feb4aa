"""The same jobs as incremental Structured Streaming runs."""
