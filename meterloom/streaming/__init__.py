"""Structured Streaming forms of the rollup and the de-duplication."""
