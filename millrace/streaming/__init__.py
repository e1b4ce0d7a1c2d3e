"""Structured Streaming forms of the incremental run and the rate metric."""
